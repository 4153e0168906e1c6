"""Row quality: typed columns, rules from the registry, accepted and rejected rows.

Rules give one boolean each and are evaluated once per row; both sides of the split follow
from the same result, so every row in scope lands on exactly one side.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.operators.keys import distinct_keys
from siftspark.operators.scope import broadcast_if_small
from siftspark.registry import REASONS, Category

ACCEPTED = "accepted"
#: A domain of up to so many values is written into the plan as literals, which reach the scan.
FEW = 200

#: Column name to a table whose first column has the values it may take.
Domains = Mapping[str, DataFrame]


def in_domains(df: DataFrame, domains: Domains | None) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with what it takes to tell whether a column's value is in its domain, and the conditions.

    A domain of a few values needs nothing but their literals; any other is joined once, by its distinct
    values, and flags the rows. The flags' names begin with `_in_`; hot values are left to AQE to split.
    """
    conditions = {}
    for name, domain in (domains or {}).items():
        values = domain.select(domain[domain.columns[0]].cast("string").alias(f"_value_{name}"))
        values = distinct_keys(values.filter(F.col(f"_value_{name}").isNotNull()))
        few = [r[0] for r in values.limit(FEW + 1).collect()]
        if len(few) <= FEW:
            conditions[name] = F.col(name).isin(few)
            continue
        flags = broadcast_if_small(values).withColumn(f"_in_{name}", F.lit(True))
        df = df.join(flags, F.col(name) == F.col(f"_value_{name}"), "left").drop(f"_value_{name}")
        conditions[name] = F.col(f"_in_{name}").isNotNull()
    return df, conditions


def rules(category: Category, domains: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Rule name to condition. NULL satisfies every rule but `required`.

    `domains` has conditions of `in_domains`; they take the place of a column's allowed values.
    """
    found, domains = {}, domains or {}
    for column in category.columns:
        value = F.col(column.name)
        if column.required:
            found[f"{column.name}:required"] = value.isNotNull()
        if column.type != "string":
            found[f"{column.name}:castable"] = (
                value.isNull() | value.try_cast(column.spark_type).isNotNull()
            )
        if column.name in domains:
            found[f"{column.name}:allowed"] = value.isNull() | domains[column.name]
        elif column.allowed:
            found[f"{column.name}:allowed"] = value.isNull() | value.isin(*column.allowed)
    return found


def reasons(conditions: dict[str, Column]) -> Column:
    """Names of the rules a row breaks."""
    return F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                for name, ok in conditions.items()
            ]
        )
    )


def typed_columns(category: Category) -> list[Column]:
    return [
        F.col(c.name).try_cast(c.spark_type).alias(c.name)
        if c.type != "string"
        else F.col(c.name)
        for c in category.columns
    ]


def typed(df: DataFrame, category: Category) -> DataFrame:
    """Columns in schema order and type; text that is no such value becomes NULL."""
    return df.select(*typed_columns(category))


def is_valid(category: Category, domains: Mapping[str, Column] | None = None) -> Column:
    """All rules kept. Never NULL, and a plain conjunction, so that Catalyst can push the
    parts of it that a file format understands down to the scan."""
    return reduce(lambda a, b: a & b, rules(category, domains).values(), F.lit(True))


def flag(df: DataFrame, category: Category, domains: Domains | None = None) -> DataFrame:
    """Rows with the boolean `accepted` and `reject_reasons`, empty for accepted rows."""
    columns = [F.col(name) for name in df.columns]
    df, known = in_domains(df, domains)
    return df.select(
        *columns, is_valid(category, known).alias(ACCEPTED), reasons(rules(category, known)).alias(REASONS)
    )


def _distinct(df: DataFrame, category: Category) -> DataFrame:
    return df.distinct() if category.distinct else df


def accepted(df: DataFrame, category: Category, domains: Domains | None = None) -> DataFrame:
    """Rows that keep all rules, typed; equal rows are merged after the cast."""
    df, known = in_domains(df, domains)
    return _distinct(typed(df.filter(is_valid(category, known)), category), category)


def rejected(df: DataFrame, category: Category, domains: Domains | None = None) -> DataFrame:
    """Rows that break a rule, as the raw text they were, with the reasons."""
    df, known = in_domains(df, domains)
    flags = [F.col(f"_in_{name}") for name in known if f"_in_{name}" in df.columns]
    bad = df.filter(~is_valid(category, known)).select(*category.names, *flags)
    # Equal rows have equal reasons, so copies are merged before reasons are spelled out.
    why = reasons(rules(category, known)).alias(REASONS)
    return _distinct(bad, category).select(*category.names, why)


def split(df: DataFrame, category: Category, domains: Domains | None = None) -> DataFrame:
    """Both sides from one scan: (accepted, silver struct, rejected struct).

    Exactly one of the structs is set. Written partitioned by `accepted`, it is the staged
    form the two tables are loaded from.
    """
    df, known = in_domains(df, domains)
    raw = [F.col(n) for n in category.names]
    flags = [f"_in_{name}" for name in known if f"_in_{name}" in df.columns]
    ok = F.col(ACCEPTED)
    both = df.select(*raw, *flags, is_valid(category, known).alias(ACCEPTED)).select(
        ACCEPTED,
        F.when(ok, F.struct(*typed_columns(category))).alias("silver"),
        *[F.when(~ok, F.col(n)).alias(n) for n in [*category.names, *flags]],
    )
    # Equal rows break the same rules, so copies are merged before reasons are spelled out.
    why = F.struct(*raw, reasons(rules(category, known)).alias(REASONS))
    return _distinct(both, category).select(
        ACCEPTED, "silver", F.when(~ok, why).alias("rejected")
    )
