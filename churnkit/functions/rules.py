"""Column expressions for row-wise rules. All stay inside whole-stage code generation."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    ">=": operator.ge,
    ">": operator.gt,
}

Step = tuple[str, Any, Any]  # comparison, bound, result


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _first_match(branches: Iterable[tuple[Column, Any]], otherwise: Any) -> Column:
    branches = list(branches)
    head, *rest = branches
    chain = reduce(lambda c, b: c.when(b[0], b[1]), rest, F.when(head[0], head[1]))
    return chain if otherwise is None else chain.otherwise(otherwise)


def map_values(col: Column | str, mapping: Mapping[Any, Any], otherwise: Any = None) -> Column:
    """Replace each listed value; anything else (null too) becomes ``otherwise``."""
    c = as_column(col)
    return _first_match(((c == old, new) for old, new in mapping.items()), otherwise)


def prefix_class(col: Column | str, classes: Mapping[str, str], otherwise: str) -> Column:
    """Label by what the text starts with."""
    c = as_column(col)
    return _first_match(((c.startswith(p), label) for p, label in classes.items()), otherwise)


def tier(col: Column | str, steps: Sequence[Step], otherwise: Any) -> Column:
    """Label of the first step that holds; null holds for none, so it gets ``otherwise``."""
    c = as_column(col)
    return _first_match(((COMPARE[op](c, bound), label) for op, bound, label in steps), otherwise)


def flag(condition: Column, yes: Any = "Yes", no: Any = "No") -> Column:
    """Two-valued label; an unknown condition counts as no."""
    return F.when(condition, yes).otherwise(no)


def ratio_or(num: Column | str, den: Column | str, digits: int = 2, default: float = 0.0) -> Column:
    """Rounded ``num / den``, or ``default`` unless the denominator is positive."""
    n, d = as_column(num), as_column(den)
    return F.round(F.when(d > 0, n / d).otherwise(F.lit(default)), digits)


def at_most_one_ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """``ratio_or`` that never exceeds 1; a null numerator stays null."""
    n, d = as_column(num), as_column(den)
    # least() would skip a null numerator, so the share is formed from a numerator capped by CASE.
    return ratio_or(F.when(n > d, d).otherwise(n), d, digits)


def number_or(col: Column | str, kind: str, default: float | int = 0) -> Column:
    """Text to number; junk, blank and null become ``default``."""
    return F.coalesce(F.trim(as_column(col)).try_cast(kind), F.lit(default).cast(kind))


def rule_points(rules: Iterable[tuple[str, str, Any, int]]) -> Column:
    """Sum the points of all rules ``(column, comparison, bound, points)`` that hold; null never holds."""
    points = [
        F.when(COMPARE[op](F.col(name), bound), F.lit(worth)).otherwise(F.lit(0))
        for name, op, bound, worth in rules
    ]
    return reduce(operator.add, points)
