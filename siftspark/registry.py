"""Category registry: the columns of each category's tables and the rules its rows must meet.

Rules are data. Everything that differs between categories (types, required columns,
allowed values, merge keys) is stated here once, and the operators are generic over it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Published column lists, types, merge keys and allowed values.
# ---------------------------------------------------------------------------

COLUMNS = {
    "entity": """
        experiment id details formula_weight pdbx_description pdbx_ec
        pdbx_entities_per_biological_unit pdbx_formula_weight_exptl
        pdbx_formula_weight_exptl_method pdbx_fragment pdbx_modification pdbx_mutation
        pdbx_number_of_molecules pdbx_parent_entity_id pdbx_target_id src_method type
    """.split(),
    "entity_poly_seq": "experiment entity_id mon_id num hetero".split(),
    "chem_comp": """
        experiment id formula formula_weight model_details model_erf model_source
        mon_nstd_class mon_nstd_details mon_nstd_flag mon_nstd_parent
        mon_nstd_parent_comp_id name number_atoms_all number_atoms_nh one_letter_code
        pdbx_ambiguous_flag pdbx_casnum pdbx_class_1 pdbx_class_2 pdbx_comp_type
        pdbx_component_no pdbx_formal_charge pdbx_ideal_coordinates_details
        pdbx_ideal_coordinates_missing_flag pdbx_initial_date
        pdbx_model_coordinates_db_code pdbx_model_coordinates_details
        pdbx_model_coordinates_missing_flag pdbx_modification_details
        pdbx_modified_date pdbx_nscnum pdbx_number_subcomponents pdbx_pcm
        pdbx_processing_site pdbx_release_status pdbx_replaced_by pdbx_replaces
        pdbx_reserved_name pdbx_smiles pdbx_status pdbx_subcomponent_list pdbx_synonyms
        pdbx_type pdbx_type_modified three_letter_code type
    """.split(),
    "exptl": "experiment entry_id method".split(),
    "pdbx_database_PDB_obs_spr": "experiment pdb_id replace_pdb_id date details id".split(),
}

TYPES = {
    "entity": {
        "formula_weight": "float",
        "pdbx_entities_per_biological_unit": "float",
        "pdbx_formula_weight_exptl": "float",
        "pdbx_number_of_molecules": "int",
    },
    "entity_poly_seq": {"num": "int"},
    "chem_comp": {
        "formula_weight": "float",
        "number_atoms_all": "int",
        "number_atoms_nh": "int",
        "pdbx_formal_charge": "int",
        "pdbx_initial_date": "date",
        "pdbx_modified_date": "date",
        "pdbx_number_subcomponents": "int",
    },
    "exptl": {},
    "pdbx_database_PDB_obs_spr": {"date": "date"},
}

REQUIRED = {
    "entity": ["experiment", "id"],
    "entity_poly_seq": ["experiment", "entity_id", "mon_id", "num"],
    "chem_comp": ["experiment", "id", "type"],
    "exptl": ["experiment", "entry_id", "method"],
    "pdbx_database_PDB_obs_spr": ["experiment", "pdb_id", "replace_pdb_id", "date", "id"],
}

KEYS = {
    "entity": ["experiment", "id"],
    "entity_poly_seq": ["experiment", "entity_id", "mon_id", "num"],
    "chem_comp": ["experiment", "id"],
    "exptl": ["experiment", "entry_id", "method"],
    "pdbx_database_PDB_obs_spr": ["experiment", "pdb_id", "replace_pdb_id"],
}

ALLOWED = {
    "entity": {
        "src_method": ["man", "nat", "syn"],
        "type": ["branched", "macrolide", "non-polymer", "polymer", "water"],
    },
    "entity_poly_seq": {"hetero": ["n", "no", "y", "yes"]},
    "chem_comp": {
        "mon_nstd_flag": ["n", "no", "y", "yes"],
        "pdbx_comp_type": [
            "inorganic ligand",
            "metal cation",
            "organic ligand",
            "organometalic ligand",
            "solvent",
        ],
        "pdbx_ideal_coordinates_missing_flag": ["Y", "N"],
        "pdbx_model_coordinates_missing_flag": ["Y", "N"],
        "pdbx_pcm": ["Y", "N"],
        "pdbx_processing_site": ["EBI", "PDBC", "PDBE", "PDBJ", "RCSB"],
        "pdbx_release_status": ["DEL", "HOLD", "HPUB", "OBS", "REF_ONLY", "REL"],
        "pdbx_type_modified": ["0", "1"],
        "type": [
            "D-beta-peptide, C-gamma linking",
            "D-gamma-peptide, C-delta linking",
            "D-peptide COOH carboxy terminus",
            "D-peptide NH3 amino terminus",
            "D-peptide linking",
            "D-saccharide",
            "D-saccharide, alpha linking",
            "D-saccharide, beta linking",
            "DNA OH 3 prime terminus",
            "DNA OH 5 prime terminus",
            "DNA linking",
            "L-DNA linking",
            "L-RNA linking",
            "L-beta-peptide, C-gamma linking",
            "L-gamma-peptide, C-delta linking",
            "L-peptide COOH carboxy terminus",
            "L-peptide NH3 amino terminus",
            "L-peptide linking",
            "L-saccharide",
            "L-saccharide, alpha linking",
            "L-saccharide, beta linking",
            "RNA OH 3 prime terminus",
            "RNA OH 5 prime terminus",
            "RNA linking",
            "non-polymer",
            "other",
            "peptide linking",
            "peptide-like",
            "saccharide",
        ],
    },
    "exptl": {
        "method": [
            "ELECTRON CRYSTALLOGRAPHY",
            "ELECTRON MICROSCOPY",
            "EPR",
            "FIBER DIFFRACTION",
            "FLUORESCENCE TRANSFER",
            "INFRARED SPECTROSCOPY",
            "NEUTRON DIFFRACTION",
            "POWDER DIFFRACTION",
            "SOLID-STATE NMR",
            "SOLUTION NMR",
            "SOLUTION SCATTERING",
            "THEORETICAL MODEL",
            "X-RAY DIFFRACTION",
        ],
    },
    "pdbx_database_PDB_obs_spr": {},
}

# Categories whose accepted and rejected rows are taken as they come, copies included.
KEEPS_COPIES = {"pdbx_database_PDB_obs_spr"}

# Which categories and attributes a run asks for; '*' means every attribute.
REQUIREMENTS = [
    ("entity", "*"),
    ("pdbx_database_PDB_obs_spr", "*"),
    ("entity_poly_seq", "*"),
    ("chem_comp", "*"),
    ("exptl", "entry_id"),
    ("exptl", "method"),
]

# ---------------------------------------------------------------------------

_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "date": T.DateType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}

LINEAGE = "experiment"
REASONS = "reject_reasons"


@dataclass(frozen=True)
class Column:
    name: str
    type: str = "string"
    required: bool = False
    key: bool = False
    allowed: tuple[str, ...] = ()

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.type]


@dataclass(frozen=True)
class Category:
    """One category: ordered columns (lineage key first) and whether equal rows are merged."""

    name: str
    columns: tuple[Column, ...]
    distinct: bool = True

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def attributes(self) -> list[str]:
        return [c.name for c in self.columns if c.name != LINEAGE]

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.key]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    def bronze_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])

    def silver_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.spark_type, not c.required) for c in self.columns]
        )

    def rejected_schema(self) -> T.StructType:
        return self.bronze_schema().add(REASONS, T.ArrayType(T.StringType()))


@dataclass(frozen=True)
class Registry:
    categories: Mapping[str, Category] = field(default_factory=dict)

    def __getitem__(self, name: str) -> Category:
        return self.categories[name]

    def __iter__(self) -> Iterator[Category]:
        return iter(self.categories.values())

    def __contains__(self, name: str) -> bool:
        return name in self.categories

    @property
    def names(self) -> list[str]:
        return list(self.categories)

    def carcass(self) -> dict[str, dict[str, list]]:
        """The empty document: every category with every attribute, no values."""
        return {c.name: {a: [] for a in c.attributes} for c in self}

    def frame(self, spark: SparkSession) -> DataFrame:
        """The registry as rows, one per attribute."""
        rows = [
            (cat.name, col.name, i, col.type, col.required, col.key, list(col.allowed))
            for cat in self
            for i, col in enumerate(cat.columns)
        ]
        return spark.createDataFrame(
            rows,
            "category string, attribute string, ordinal int, type string, "
            "required boolean, is_key boolean, allowed array<string>",
        )


def category(
    name: str,
    columns: Iterable[str],
    types: Mapping[str, str] | None = None,
    required: Iterable[str] = (),
    keys: Iterable[str] = (),
    allowed: Mapping[str, Iterable[str]] | None = None,
    distinct: bool = True,
) -> Category:
    types, allowed = types or {}, allowed or {}
    required, keys = set(required), set(keys)
    return Category(
        name,
        tuple(
            Column(c, types.get(c, "string"), c in required, c in keys, tuple(allowed.get(c, ())))
            for c in columns
        ),
        distinct,
    )


def _known(name: str, columns: Iterable[str]) -> Category:
    return category(
        name,
        columns,
        TYPES.get(name),
        REQUIRED.get(name, [LINEAGE]),
        KEYS.get(name, [LINEAGE]),
        ALLOWED.get(name),
        name not in KEEPS_COPIES,
    )


def default_registry() -> Registry:
    return Registry({name: _known(name, columns) for name, columns in COLUMNS.items()})


def registry_from_frame(attributes: DataFrame) -> Registry:
    """Registry from rows (category, attribute, ordinal), e.g. those of `build_registry`.

    Types, rules and keys of known attributes are taken from the fixed values above;
    unknown attributes become plain strings. A registry is metadata on the driver, as a
    schema is; plans get the columns of one category at a time, or join with its rows.
    """
    rows = attributes.select("category", "attribute", "ordinal").collect()
    by_category: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["category"], r["ordinal"], r["attribute"])):
        names = by_category.setdefault(row["category"], [LINEAGE])
        if row["attribute"] not in names:
            names.append(row["attribute"])
    return Registry({name: _known(name, names) for name, names in by_category.items()})
