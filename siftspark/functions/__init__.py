from siftspark.functions.text import (
    after_dot,
    bucket,
    experiment_of_code_file,
    experiment_of_file,
    null_if_token,
    right_strip,
    strip_prefix,
)
from siftspark.functions.variant import attribute_arrays, has_nested_leaf, leaf_array, leaf_kind, not_held

__all__ = [
    "after_dot",
    "attribute_arrays",
    "bucket",
    "experiment_of_code_file",
    "experiment_of_file",
    "has_nested_leaf",
    "leaf_array",
    "leaf_kind",
    "not_held",
    "null_if_token",
    "right_strip",
    "strip_prefix",
]
