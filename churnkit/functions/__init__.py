from churnkit.functions.names import snake_case
from churnkit.functions.rules import (
    at_most_one_ratio,
    flag,
    map_values,
    number_or,
    prefix_class,
    ratio_or,
    rule_points,
    tier,
)

__all__ = [
    "at_most_one_ratio",
    "flag",
    "map_values",
    "number_or",
    "prefix_class",
    "ratio_or",
    "rule_points",
    "snake_case",
    "tier",
]
