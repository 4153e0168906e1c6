"""Column expressions on JSON leaves that hold either one value or an array of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_list(leaf: Column) -> Column:
    return F.try_variant_get(leaf, "$", "array<string>")


def _as_text(leaf: Column) -> Column:
    return F.try_variant_get(leaf, "$", "string")


def _is_object(leaf: Column) -> Column:
    return F.try_variant_get(leaf, "$", "map<string,variant>").isNotNull()


def has_nested_leaf(data: Column) -> Column:
    """Whether any attribute of any category holds an object, which is no value."""
    return F.exists(F.map_values(data), lambda c: F.exists(F.map_values(c), _is_object))


def leaf_array(leaf: Column) -> Column:
    """An array leaf as it is, any other leaf as an array of one."""
    return F.coalesce(_as_list(leaf), F.array(_as_text(leaf)))


def leaf_kind(leaf: Column) -> Column:
    """'list', 'dict' or 'str'."""
    return (
        F.when(_as_list(leaf).isNotNull(), F.lit("list"))
        .when(_is_object(leaf), F.lit("dict"))
        .otherwise(F.lit("str"))
    )


def attribute_arrays(attributes: Column) -> Column:
    """map<string,variant> of one category to map<string,array<string>>.

    The first attribute decides what the category is. If it is an array, the category is a
    table and a scalar attribute applies to each of its rows; if not, the category is a
    single row. Nested objects are no values and are left out.
    """
    leaves = F.map_filter(attributes, lambda _, leaf: ~_is_object(leaf))
    first = _as_list(F.get(F.map_values(leaves), F.lit(0)))
    return F.transform_values(
        leaves,
        lambda _, leaf: F.coalesce(
            _as_list(leaf),
            F.when(first.isNotNull(), F.array_repeat(_as_text(leaf), F.size(first))),
            F.array(_as_text(leaf)),
        ),
    )


def not_held(leaf: Column, value: Column, kind: T.DataType) -> Column:
    """Whether a JSON variant says anything that `value`, what a parser made of it as `kind`, does not.

    Objects are compared field by field, arrays element by element, to any depth: a field that the
    type lacks, a value the parser gave up, and a number that lost digits. A JSON null says nothing.
    """
    if isinstance(kind, T.StructType):
        fields = F.try_variant_get(leaf, "$", "map<string,variant>")
        known = F.array(*[F.lit(f.name) for f in kind]).cast("array<string>")
        lost = F.size(F.array_except(F.map_keys(fields), known)) > 0
        for f in kind:
            lost = lost | not_held(F.try_element_at(fields, F.lit(f.name)), value.getField(f.name), f.dataType)
    elif isinstance(kind, T.ArrayType):
        # One pass with the place of each element: the parsed one stands at the same place.
        elements = F.try_variant_get(leaf, "$", "array<variant>")
        flags = F.transform(elements, lambda x, i: not_held(x, F.get(value, i), kind.elementType))
        lost = (F.size(elements) != F.size(value)) | F.exists(flags, lambda flag: flag)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        # Fractions are rounded as any decimal number is; whole numbers must come back as they were.
        whole = F.try_variant_get(leaf, "$", "decimal(38,0)")
        lost = (F.abs(whole) >= 2**24) & (value.cast("decimal(38,0)") != whole)
    elif isinstance(kind, T.DecimalType):
        lost = F.try_variant_get(leaf, "$", "decimal(38,18)") != value
    else:
        lost = F.lit(False)
    said = leaf.isNotNull() & ~F.is_variant_null(leaf)
    return said & (value.isNull() | F.coalesce(lost, F.lit(False)))
