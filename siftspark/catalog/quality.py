"""Rules, the accepted/rejected split, and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.operators import (
    accepted,
    assert_unique,
    flag,
    in_scope,
    null_violations,
    pk_violations,
    rejected,
    require_rows,
)
from siftspark.registry import category

LINE = category(
    "line",
    ["experiment", "line", "quantity", "returnflag", "status"],
    types={"line": "int", "quantity": "double"},
    required=["experiment", "line", "status"],
    keys=["experiment", "line"],
    allowed={"returnflag": ["A", "N"], "status": ["F", "O"]},
)

# The same text in both dialects: order lines as strings, some of them no proper values.
_STRINGS = [
    "CAST(l_orderkey AS STRING) AS experiment",
    "CASE WHEN l_tax = 0.08 THEN 'x' ELSE CAST(l_linenumber AS STRING) END AS line",
    "CASE WHEN l_discount = 0.1 THEN 'abc' WHEN l_discount > 0 THEN CAST(l_quantity AS STRING) END"
    " AS quantity",
    "l_returnflag AS returnflag",
    "CASE WHEN l_tax > 0 THEN l_linestatus END AS status",
]

_SCOPED = f"""
    SELECT {", ".join(_STRINGS)} FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""

_VALID = """line IS NOT NULL AND TRY_CAST(line AS INTEGER) IS NOT NULL
      AND (quantity IS NULL OR TRY_CAST(quantity AS DOUBLE) IS NOT NULL)
      AND (returnflag IS NULL OR returnflag IN ('A', 'N'))
      AND status IS NOT NULL AND status IN ('F', 'O')"""

_REASONS = """concat_ws(',',
        CASE WHEN line IS NULL THEN 'line:required' END,
        CASE WHEN line IS NOT NULL AND TRY_CAST(line AS INTEGER) IS NULL THEN 'line:castable' END,
        CASE WHEN quantity IS NOT NULL AND TRY_CAST(quantity AS DOUBLE) IS NULL
          THEN 'quantity:castable' END,
        CASE WHEN returnflag NOT IN ('A', 'N') THEN 'returnflag:allowed' END,
        CASE WHEN status IS NULL THEN 'status:required' END,
        CASE WHEN status NOT IN ('F', 'O') THEN 'status:allowed' END)"""


def scoped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .select(F.col("o_orderkey").cast("string").alias("experiment"))
    )
    return in_scope(table(spark, sf_dir, "lineitem").selectExpr(*_STRINGS), scope)


@query(
    f"""SELECT DISTINCT experiment, CAST(line AS INTEGER) AS line,
      CAST(quantity AS DOUBLE) AS quantity, returnflag, status
    FROM ({_SCOPED}) WHERE {_VALID}"""
)
def quality_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope, rules, types, distinct: the rows a silver table takes in."""
    return accepted(scoped_lines(spark, sf_dir), LINE)


@query(
    f"""SELECT DISTINCT *, {_REASONS} AS reasons FROM ({_SCOPED})
    WHERE NOT COALESCE({_VALID}, FALSE)"""
)
def quality_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complement, as raw text, with the rules broken."""
    bad = rejected(scoped_lines(spark, sf_dir), LINE)
    return bad.select(*LINE.names, F.array_join("reject_reasons", ",").alias("reasons"))


@query(
    f"""SELECT reason, count(*) AS n FROM (
      SELECT unnest(string_split({_REASONS}, ',')) AS reason FROM ({_SCOPED}))
    WHERE reason <> '' GROUP BY reason"""
)
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag(scoped_lines(spark, sf_dir), LINE)
    reasons = flagged.select(F.explode("reject_reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT (quantity IS NULL OR TRY_CAST(quantity AS DOUBLE) IS NOT NULL) AS optional_ok,
      TRY_CAST(line AS INTEGER) IS NOT NULL AS required_ok, count(*) AS n
    FROM (SELECT {", ".join(_STRINGS)} FROM lineitem) GROUP BY 1, 2"""
)
def castable_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Castable or NULL, and castable and not NULL."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(*_STRINGS)
    broken = flag(lines, LINE).select("reject_reasons")
    checked = broken.select(
        (~F.array_contains("reject_reasons", "quantity:castable")).alias("optional_ok"),
        (
            ~F.arrays_overlap(
                "reject_reasons", F.array(F.lit("line:castable"), F.lit("line:required"))
            )
        ).alias("required_ok"),
    )
    return checked.groupBy("optional_ok", "required_ok").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT (returnflag IS NULL OR returnflag IN ('A', 'N')) AS optional_ok,
      COALESCE(status IN ('F', 'O'), FALSE) AS required_ok, count(*) AS n
    FROM (SELECT {", ".join(_STRINGS)} FROM lineitem) GROUP BY 1, 2"""
)
def domain_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the domain or NULL, and in the domain and not NULL."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(*_STRINGS)
    broken = flag(lines, LINE).select("reject_reasons")
    checked = broken.select(
        (~F.array_contains("reject_reasons", "returnflag:allowed")).alias("optional_ok"),
        (
            ~F.arrays_overlap(
                "reject_reasons", F.array(F.lit("status:allowed"), F.lit("status:required"))
            )
        ).alias("required_ok"),
    )
    return checked.groupBy("optional_ok", "required_ok").agg(F.count(F.lit(1)).alias("n"))


ITEM = category(
    "item",
    ["experiment", "line", "part", "supplier", "mode"],
    types={"line": "int"},
    required=["experiment", "supplier"],
    keys=["experiment", "line"],
)

_ITEMS = [
    "CAST(l_orderkey AS STRING) AS experiment",
    "CAST(l_linenumber AS STRING) AS line",
    "CASE WHEN l_discount < 0.09 THEN CAST(l_partkey AS STRING) END AS part",
    "CASE WHEN l_tax < 0.07 THEN CAST(l_suppkey AS STRING) END AS supplier",
    "l_linestatus AS mode",
]

_ITEM_RULES = {
    "part:allowed": "part IS NULL OR part IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <> 7)",
    "supplier:allowed": "supplier IS NULL "
    "OR supplier IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 0)",
    "supplier:required": "supplier IS NOT NULL",
    "mode:allowed": "mode IS NULL OR mode IN (SELECT o_orderstatus FROM orders WHERE o_orderstatus <> 'F')",
}


def _items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Order lines as text, and domains of a share of all parts, of all suppliers, and of two statuses."""
    domains = {
        "part": table(spark, sf_dir, "part").filter("p_size <> 7").select("p_partkey"),
        "supplier": table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select("s_suppkey"),
        "mode": table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").select("o_orderstatus"),
    }
    return table(spark, sf_dir, "lineitem").selectExpr(*_ITEMS), domains


@query(
    f"""SELECT DISTINCT experiment, CAST(line AS INTEGER) AS line, part, supplier, mode
    FROM (SELECT {", ".join(_ITEMS)} FROM lineitem)
    WHERE {" AND ".join(f"({ok})" for ok in _ITEM_RULES.values())}"""
)
def domain_tables_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that must be in other tables, of any size: the rows that keep the rules."""
    items, domains = _items(spark, sf_dir)
    return accepted(items, ITEM, domains)


@query(
    f"""SELECT * FROM (SELECT DISTINCT *, concat_ws(',', {
        ", ".join(f"CASE WHEN NOT ({ok}) THEN '{name}' END" for name, ok in sorted(_ITEM_RULES.items()))
    }) AS reasons FROM (SELECT {", ".join(_ITEMS)} FROM lineitem)) WHERE reasons <> ''"""
)
def domain_tables_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other rows, with the names of the domains their values are not in."""
    items, domains = _items(spark, sf_dir)
    broken = F.array_join(F.array_sort("reject_reasons"), ",")
    return rejected(items, ITEM, domains).select(*ITEM.names, broken.alias("reasons"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def required_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes rows on that exist and whose key is unique; raises otherwise."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return assert_unique(require_rows(orders, "no orders"), ["o_orderkey"])


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT 'event_id' AS "column", count(*) - count(event_id) AS n_null FROM events
    UNION ALL SELECT 'value', count(*) FILTER (WHERE event_type = 'error') FROM events
    UNION ALL SELECT 'props', count(*) FILTER (WHERE value < 1) FROM events"""
)
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_type <> 'error' THEN value END AS value",
        "CASE WHEN value >= 1 THEN props END AS props",
    )
    return null_violations(events, ["event_id", "value", "props"])
