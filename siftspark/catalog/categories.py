"""The silver and rejected tables of each category, merged onto what they held before.

Every category's bronze rows are whole tables under the category's column names, with the
flaws that the rules are for. `_Case` states them, and the rules, once more in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.operators import accepted, conform, in_scope, merge_upsert, rejected
from siftspark.registry import default_registry
from siftspark.session import staged

REGISTRY = default_registry()


@dataclass(frozen=True)
class _Case:
    """Bronze columns over one table (text valid in both dialects), scope, and held rows."""

    category: str
    source: str
    columns: dict[str, str]
    scope: tuple[str, str, str]  # table, experiment expression, condition
    held: str  # condition on the source table for rows merged by an earlier run
    touch: tuple[str, str] | None  # a text column and the value the held rows have there
    casts: dict[str, str]
    rules: dict[str, str]  # what each rule asks of a row; one that is not true breaks it

    @property
    def valid(self) -> str:
        return "(" + " AND ".join(f"({ok})" for ok in self.rules.values()) + ")"

    def bronze(self, spark: SparkSession, sf_dir: str, held: bool = False) -> DataFrame:
        rows = table(spark, sf_dir, self.source)
        rows = rows.filter(self.held) if held else rows
        cells = rows.selectExpr(*[f"{text} AS {name}" for name, text in self.columns.items()])
        if held and self.touch:
            cells = cells.withColumn(self.touch[0], F.lit(self.touch[1]))
        return conform(cells, REGISTRY[self.category].names)

    def scoped(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        source, experiment, condition = self.scope
        scope = table(spark, sf_dir, source).filter(condition)
        pairs = scope.selectExpr(f"'{self.category}' AS category", f"{experiment} AS experiment")
        return in_scope(self.bronze(spark, sf_dir), pairs, self.category)

    def silver(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = REGISTRY[self.category]
        target = accepted(self.bronze(spark, sf_dir, held=True), spec)
        source = staged(accepted(self.scoped(spark, sf_dir), spec), "source")
        merged = merge_upsert(target, source, spec.keys)
        return merged.select(
            *[
                F.col(c.name).cast("double").alias(c.name) if c.type == "float" else F.col(c.name)
                for c in spec.columns
            ]
        )

    def reject(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = REGISTRY[self.category]
        target = rejected(self.bronze(spark, sf_dir, held=True), spec)
        source = staged(rejected(self.scoped(spark, sf_dir), spec), "source")
        merged = merge_upsert(target, source, spec.keys, null_safe=True)
        broken = F.array_join(F.array_sort("reject_reasons"), ",")
        return merged.select(*spec.names, broken.alias("reasons"))

    def _bronze_sql(self, held: bool) -> str:
        texts = {n: "CAST(NULL AS VARCHAR)" for n in REGISTRY[self.category].names} | self.columns
        if held and self.touch:
            texts[self.touch[0]] = f"'{self.touch[1]}'"
        cells = [f"{texts[name]} AS {name}" for name in REGISTRY[self.category].names]
        where = f"WHERE {self.held}" if held else ""
        return f"SELECT {', '.join(cells)} FROM {self.source} {where}"

    def _sides(self, condition: str, columns: str, distinct: bool) -> str:
        scope_table, experiment, scope_condition = self.scope
        unique = "DISTINCT" if distinct else ""
        return f"""held AS (SELECT {unique} {columns} FROM ({self._bronze_sql(True)}) WHERE {condition}),
        fresh AS (SELECT {unique} {columns} FROM ({self._bronze_sql(False)}) WHERE {condition}
          AND experiment IN (SELECT {experiment} FROM {scope_table} WHERE {scope_condition}))"""

    def silver_sql(self) -> str:
        spec = REGISTRY[self.category]
        columns = ", ".join(
            f"CAST({n} AS {self.casts[n]}) AS {n}" if n in self.casts else n for n in spec.names
        )
        same = " AND ".join(f"f.{k} = h.{k}" for k in spec.keys)
        out = ", ".join(
            f"CAST({n} AS DOUBLE) AS {n}" if self.casts.get(n) == "FLOAT" else n for n in spec.names
        )
        return f"""WITH {self._sides(self.valid, columns, spec.distinct)}
        SELECT {out} FROM (SELECT * FROM fresh UNION ALL
          SELECT * FROM held h WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE {same}))"""

    def reject_sql(self) -> str:
        spec = REGISTRY[self.category]
        columns = ", ".join(spec.names)
        same = " AND ".join(f"f.{k} IS NOT DISTINCT FROM h.{k}" for k in spec.keys)
        condition = f"NOT COALESCE({self.valid}, FALSE)"
        broken = ", ".join(f"CASE WHEN NOT COALESCE({ok}, FALSE) THEN '{name}' END" for name, ok in self.rules.items())
        return f"""WITH {self._sides(condition, columns, spec.distinct)}
        SELECT *, array_to_string(list_sort(list_filter([{broken}], lambda x: x IS NOT NULL)), ',') AS reasons
        FROM (SELECT * FROM fresh UNION ALL
          SELECT * FROM held h WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE {same}))"""


ENTITY = _Case(
    category="entity",
    source="events",
    columns={
        "experiment": "concat('U', CAST(user_id AS STRING))",
        "id": "CASE WHEN event_type <> 'error' OR value > 20 THEN CAST(event_id AS STRING) END",
        "details": "props",
        "formula_weight": "CASE WHEN value > 150 THEN concat('>', CAST(value AS STRING)) "
        "ELSE CAST(value AS STRING) END",
        "pdbx_number_of_molecules": "regexp_extract(props, '([0-9]+)', 1)",
        "src_method": "CASE event_type WHEN 'click' THEN 'man' WHEN 'view' THEN 'nat' "
        "WHEN 'purchase' THEN 'syn' END",
        "type": "CASE event_type WHEN 'click' THEN 'polymer' WHEN 'view' THEN 'water' "
        "WHEN 'signup' THEN 'non-polymer' WHEN 'purchase' THEN 'Polymer' END",
    },
    scope=("events", "concat('U', CAST(user_id AS STRING))", "value > 250"),
    held="event_type IN ('click', 'error')",
    touch=("details", "held"),
    casts={
        "formula_weight": "FLOAT",
        "pdbx_entities_per_biological_unit": "FLOAT",
        "pdbx_formula_weight_exptl": "FLOAT",
        "pdbx_number_of_molecules": "INTEGER",
    },
    rules={
        "experiment:required": "experiment IS NOT NULL",
        "id:required": "id IS NOT NULL",
        "formula_weight:castable": "formula_weight IS NULL OR TRY_CAST(formula_weight AS FLOAT) IS NOT NULL",
        "pdbx_number_of_molecules:castable": "pdbx_number_of_molecules IS NULL "
        "OR TRY_CAST(pdbx_number_of_molecules AS INTEGER) IS NOT NULL",
        "src_method:allowed": "src_method IS NULL OR src_method IN ('man', 'nat', 'syn')",
        "type:allowed": "type IS NULL OR type IN ('branched', 'macrolide', 'non-polymer', 'polymer', 'water')",
    },
)

POLY_SEQ = _Case(
    category="entity_poly_seq",
    source="lineitem",
    columns={
        "experiment": "CAST(l_orderkey AS STRING)",
        "entity_id": "CAST(l_suppkey AS STRING)",
        "mon_id": "CASE WHEN l_tax > 0 THEN l_returnflag END",
        "num": "CASE WHEN l_discount = 0.1 THEN 'x' WHEN l_discount > 0.05 THEN "
        "concat('0', CAST(l_linenumber AS STRING)) ELSE CAST(l_linenumber AS STRING) END",
        "hetero": "CASE WHEN l_quantity > 40 THEN 'maybe' WHEN l_linestatus = 'F' THEN 'n' END",
    },
    scope=("orders", "CAST(o_orderkey AS STRING)", "o_orderstatus <> 'O'"),
    held="l_returnflag = 'R'",
    touch=("hetero", "yes"),
    casts={"num": "INTEGER"},
    rules={
        "experiment:required": "experiment IS NOT NULL",
        "entity_id:required": "entity_id IS NOT NULL",
        "mon_id:required": "mon_id IS NOT NULL",
        "num:required": "num IS NOT NULL",
        "num:castable": "num IS NULL OR TRY_CAST(num AS INTEGER) IS NOT NULL",
        "hetero:allowed": "hetero IS NULL OR hetero IN ('n', 'no', 'y', 'yes')",
    },
)

CHEM_COMP = _Case(
    category="chem_comp",
    source="part",
    columns={
        "experiment": "p_brand",
        "id": "CAST(p_partkey AS STRING)",
        "formula": "p_name",
        "formula_weight": "CASE WHEN p_size = 7 THEN 'n/a' ELSE CAST(p_retailprice AS STRING) END",
        "mon_nstd_flag": "CASE WHEN p_size < 25 THEN 'y' WHEN p_size < 48 THEN 'no' ELSE 'N' END",
        "name": "concat(p_brand, ' ', p_name)",
        "number_atoms_all": "CAST(p_size AS STRING)",
        "pdbx_comp_type": "CASE WHEN p_size = 9 THEN 'metal' WHEN p_size = 10 THEN 'metal cation' END",
        "pdbx_initial_date": "concat('2021-02-', lpad(CAST(p_size AS STRING), 2, '0'))",
        "pdbx_processing_site": "CASE WHEN p_size = 11 THEN 'rcsb' ELSE 'RCSB' END",
        "pdbx_release_status": "CASE WHEN p_size = 12 THEN 'NEW' ELSE 'REF_ONLY' END",
        "pdbx_type_modified": "CASE WHEN p_size = 13 THEN '2' WHEN p_size > 13 THEN '1' END",
        "type": "CASE p_type WHEN 'ECONOMY' THEN 'L-peptide linking' WHEN 'LARGE' THEN 'saccharide' "
        "WHEN 'SMALL' THEN 'D-saccharide, alpha linking' WHEN 'STANDARD' THEN 'non-polymer' "
        "WHEN 'MEDIUM' THEN 'Other' END",
    },
    scope=("part", "p_brand", "p_size = 1"),
    held="p_type IN ('LARGE', 'PROMO')",
    touch=("formula", "held"),
    casts={
        "formula_weight": "FLOAT",
        "number_atoms_all": "INTEGER",
        "number_atoms_nh": "INTEGER",
        "pdbx_formal_charge": "INTEGER",
        "pdbx_initial_date": "DATE",
        "pdbx_modified_date": "DATE",
        "pdbx_number_subcomponents": "INTEGER",
    },
    rules={
        "experiment:required": "experiment IS NOT NULL",
        "id:required": "id IS NOT NULL",
        "type:required": "type IS NOT NULL",
        "formula_weight:castable": "formula_weight IS NULL OR TRY_CAST(formula_weight AS FLOAT) IS NOT NULL",
        "number_atoms_all:castable": "number_atoms_all IS NULL OR TRY_CAST(number_atoms_all AS INTEGER) IS NOT NULL",
        "pdbx_initial_date:castable": "pdbx_initial_date IS NULL OR TRY_CAST(pdbx_initial_date AS DATE) IS NOT NULL",
        "mon_nstd_flag:allowed": "mon_nstd_flag IS NULL OR mon_nstd_flag IN ('n', 'no', 'y', 'yes')",
        "pdbx_comp_type:allowed": "pdbx_comp_type IS NULL OR pdbx_comp_type IN ('inorganic ligand', 'metal cation', "
        "'organic ligand', 'organometalic ligand', 'solvent')",
        "pdbx_processing_site:allowed": "pdbx_processing_site IS NULL "
        "OR pdbx_processing_site IN ('EBI', 'PDBC', 'PDBE', 'PDBJ', 'RCSB')",
        "pdbx_release_status:allowed": "pdbx_release_status IS NULL "
        "OR pdbx_release_status IN ('DEL', 'HOLD', 'HPUB', 'OBS', 'REF_ONLY', 'REL')",
        "pdbx_type_modified:allowed": "pdbx_type_modified IS NULL OR pdbx_type_modified IN ('0', '1')",
        "type:allowed": "type IS NULL OR type IN ('L-peptide linking', 'saccharide', 'D-saccharide, alpha linking', "
        "'non-polymer', 'other', 'peptide linking', 'peptide-like')",
    },
)

EXPTL = _Case(
    category="exptl",
    source="orders",
    columns={
        "experiment": "CAST(o_custkey AS STRING)",
        "entry_id": "CASE WHEN o_totalprice > 1000 THEN CAST(o_orderkey AS STRING) END",
        "method": "CASE o_orderpriority WHEN '1-URGENT' THEN 'X-RAY DIFFRACTION' "
        "WHEN '2-HIGH' THEN 'EPR' WHEN '3-MEDIUM' THEN 'INFRARED SPECTROSCOPY' "
        "WHEN '4-NOT SPECIFIED' THEN 'Solution NMR' END",
    },
    scope=("customer", "CAST(c_custkey AS STRING)", "c_mktsegment <> 'MACHINERY'"),
    held="o_orderstatus = 'F'",
    touch=None,
    casts={},
    rules={
        "entry_id:required": "entry_id IS NOT NULL",
        "method:required": "method IS NOT NULL",
        "method:allowed": "method IS NULL OR method IN ('X-RAY DIFFRACTION', 'EPR', 'INFRARED SPECTROSCOPY', "
        "'SOLUTION NMR')",
    },
)

OBS_SPR = _Case(
    category="pdbx_database_PDB_obs_spr",
    source="orders",
    columns={
        "experiment": "CAST(o_custkey AS STRING)",
        "pdb_id": "o_orderpriority",
        "replace_pdb_id": "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS STRING) END",
        "date": "CASE WHEN o_totalprice > 400000 THEN 'soon' "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
        "details": "o_orderstatus",
        "id": "'OBSLTE'",
    },
    scope=("customer", "CAST(c_custkey AS STRING)", "c_acctbal > 0"),
    held="o_orderpriority = '5-LOW'",
    touch=("details", "held"),
    casts={"date": "DATE"},
    rules={
        "experiment:required": "experiment IS NOT NULL",
        "pdb_id:required": "pdb_id IS NOT NULL",
        "replace_pdb_id:required": "replace_pdb_id IS NOT NULL",
        "date:required": "date IS NOT NULL",
        "date:castable": "date IS NULL OR TRY_CAST(date AS DATE) IS NOT NULL",
        "id:required": "id IS NOT NULL",
    },
)


@query(ENTITY.silver_sql())
def silver_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ENTITY.silver(spark, sf_dir)


@query(ENTITY.reject_sql())
def rejected_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ENTITY.reject(spark, sf_dir)


@query(POLY_SEQ.silver_sql())
def silver_entity_poly_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return POLY_SEQ.silver(spark, sf_dir)


@query(POLY_SEQ.reject_sql())
def rejected_entity_poly_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return POLY_SEQ.reject(spark, sf_dir)


@query(CHEM_COMP.silver_sql())
def silver_chem_comp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CHEM_COMP.silver(spark, sf_dir)


@query(CHEM_COMP.reject_sql())
def rejected_chem_comp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CHEM_COMP.reject(spark, sf_dir)


@query(EXPTL.silver_sql())
def silver_exptl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EXPTL.silver(spark, sf_dir)


@query(EXPTL.reject_sql())
def rejected_exptl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EXPTL.reject(spark, sf_dir)


@query(OBS_SPR.silver_sql())
def silver_obs_spr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return OBS_SPR.silver(spark, sf_dir)


@query(OBS_SPR.reject_sql())
def rejected_obs_spr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return OBS_SPR.reject(spark, sf_dir)
