"""Names under which feature functions can be written into a spec."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

from entityloom.functions import scalars as S

PairFunction = Callable[[Column, Column], Column]

PAIR_FUNCTIONS: dict[str, PairFunction] = {
    "ratio_null": S.ratio_null,
    "ratio_ieee": S.ratio_ieee,
    "ratio_clamped": S.ratio_clamped,
    "ratio_guarded": S.ratio_guarded,
    "sum": S.pair_sum,
    "diff": S.pair_diff,
    "product": S.pair_product,
    "norm": S.pair_norm,
    "angle": S.pair_angle,
}

# Functions that need the other rows of a group (see operators.rollup).
GROUP_FUNCTIONS = ("group_std", "group_count")

# The function names stored in existing spec files.
STORED_NAMES = {
    "divide_feature_creator": "ratio_guarded",
    "sum_feature_creator": "sum",
    "std_feature_creator": "group_std",
    "mul_feature_creator": "product",
    "euclidean_feature_creator": "norm",
    "atan2_feature_creator": "angle",
    "count_feature_creator": "group_count",
}

# The functions the feature search may draw from.
SEARCH_FUNCTIONS = ("ratio_guarded", "product", "sum", "angle", "norm")


def canonical_name(name: str) -> str:
    """The registry name for a registry or stored name."""
    resolved = STORED_NAMES.get(name, name)
    if resolved not in PAIR_FUNCTIONS and resolved not in GROUP_FUNCTIONS:
        known = sorted([*PAIR_FUNCTIONS, *GROUP_FUNCTIONS, *STORED_NAMES])
        raise ValueError(f"unknown feature function {name!r}; known: {', '.join(known)}")
    return resolved


def register(name: str, function: PairFunction) -> None:
    """Make a new pair function usable in feature specs."""
    if name in PAIR_FUNCTIONS or name in GROUP_FUNCTIONS or name in STORED_NAMES:
        raise ValueError(f"feature function {name!r} exists")
    PAIR_FUNCTIONS[name] = function
