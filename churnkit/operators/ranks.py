"""Quantiles of many columns in one go, by a bounded sketch or exactly."""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.operators.order import PART, part_starts, place_in_order

Marks = dict[str, list[float]]
# Groups in which the sketches of tasks are merged before those of a column meet.
MERGE_GROUPS = 256


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], rel_error: float = 0.01
) -> Marks:
    """Quantiles of all columns: from a sketch, or exact for ``rel_error`` 0.

    Nulls and NaN are left out; a column without values gets ``[]``.
    """
    names = list(dict.fromkeys(columns))
    if not names:
        return {}
    if rel_error == 0:
        return exact_quantiles(df, names, probs)
    return sketch_quantiles(df, names, probs, rel_error)


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN as null."""
    return df.selectExpr(*[f"nullif(double(`{c}`), double('NaN')) AS `{c}`" for c in columns])


def _by_name(wide: DataFrame) -> DataFrame:
    """Rows ``(name, value)`` of all columns, nulls left out."""
    return wide.unpivot([], wide.columns, "name", "value").filter("value IS NOT NULL")


def sketch_size(rel_error: float) -> int:
    """Parameter of a KLL sketch whose error at 99 % confidence is half of ``rel_error``; that leaves all of it next to certain."""
    # The published fit of the two-sided rank error, 2.446 / k ** 0.9433.
    return min(max(math.ceil((2.446 / (rel_error / 2)) ** (1 / 0.9433)), 8), 65535)


def column_sketches(df: DataFrame, columns: Sequence[str], rel_error: float, groups: int = MERGE_GROUPS) -> DataFrame:
    """One KLL sketch of each column's values, nulls and NaN left out: (name, sketch).

    Every task sketches all columns at once. Sketches are merged in two levels, first those of every ``groups``-th task,
    then one a group, so no task merges those of all tasks. A column without values has no row.
    """
    k = sketch_size(rel_error)
    task = F.pmod(F.spark_partition_id(), F.lit(groups)).alias("_group")
    wide = _numbers(df, columns).select(task, *[F.col(f"`{c}`") for c in columns])
    rows = wide.unpivot(["_group"], list(columns), "name", "value").filter("value IS NOT NULL")
    merged = rows.groupBy("name", "_group").agg(F.kll_sketch_agg_double("value", k).alias("sketch"))
    return merged.groupBy("name").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], rel_error: float, groups: int = MERGE_GROUPS
) -> Marks:
    """Values whose rank is off by at most ``rel_error`` of the rows, next to certainly; lowest and highest are exact.

    The sketches draw lots, so two runs may give different values within the error.
    """
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    marks = F.kll_sketch_get_quantile_double("sketch", wanted).alias("marks")
    found = {r["name"]: list(r["marks"]) for r in column_sketches(df, columns, rel_error, groups).select("name", marks).collect()}
    return {c: found.get(c, []) for c in columns}


def _literal(x: float) -> str:
    return f"double('{x!r}')" if math.isinf(x) else f"{x!r}D"


def _below(x: float) -> float:
    """Stands for all values under ``x`` that no interval holds."""
    return math.nextafter(x, -math.inf)


def _snapped(name: str, cuts: Sequence[float | None]) -> str:
    """Values outside the intervals ``cuts = [low, high, low, high, ..]``, ends included, moved up to just below the next one.

    That leaves the number of values at or below any point inside an interval as it is, while all
    the others fall together. ``None`` as an end is no bound. It is SQL text, since a
    thousand expression objects take longer to build than the query takes to run.
    """
    branches = []
    for low, high in zip(cuts[::2], cuts[1::2]):
        if low is not None:
            branches.append(f"WHEN `{name}` < {_literal(low)} THEN {_literal(_below(low))}")
        branches.append(
            f"WHEN `{name}` <= {_literal(high)} THEN `{name}`" if high is not None else f"WHEN true THEN `{name}`"
        )
    rest = f"WHEN `{name}` IS NOT NULL THEN double('Infinity')"
    return f"CASE WHEN `{name}` IS NULL THEN NULL {' '.join(branches)} {rest} END AS `{name}`"


def _inside(value: float, cuts: Sequence[float | None]) -> bool:
    """Whether an interval holds the value, which then is one of the column's and not one that others fell together on."""
    return any((low is None or low <= value) and (high is None or value <= high) for low, high in zip(cuts[::2], cuts[1::2]))


def _intervals(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], error: float
) -> dict[str, list[float | None]]:
    """Interval of each column that very likely holds each quantile."""
    ends = [(max(p - 2 * error, 0.0), min(p + 2 * error, 1.0)) for p in sorted(probs)]
    flat = [e for pair in ends for e in pair]
    found = sketch_quantiles(df, columns, flat, error)
    return {
        name: [None if e in (0.0, 1.0) else m for e, m in zip(flat, marks)]
        for name, marks in found.items()
        if marks
    }


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], sketch_error: float = 0.001
) -> Marks:
    """Smallest value whose share of rows at or below it reaches each probability.

    A sketch gives a narrow interval for each quantile, so that only values inside are counted one
    by one. The sorted counts give for every wanted rank the part that holds it, and only those
    parts are read again. A quantile that its interval missed shows as a value outside of all; such columns are then
    counted without intervals.
    """
    cuts = _intervals(df, columns, probs, sketch_error)
    found = _counted_quantiles(df, cuts, probs)
    missed = {c: [None, None] for c, marks in found.items() if not all(_inside(m, cuts[c]) for m in marks)}
    found |= _counted_quantiles(df, missed, probs)
    return {c: found.get(c, []) for c in columns}


def _counted_quantiles(df: DataFrame, cuts: dict[str, list[float | None]], probs: Sequence[float]) -> Marks:
    """Quantiles by counting each value inside the intervals, the others together."""
    if not cuts:
        return {}
    counts = (
        _by_name(_numbers(df, list(cuts)).selectExpr(*[_snapped(c, ends) for c, ends in cuts.items()]))
        .groupBy("name", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = place_in_order(counts, ["name", "value"])
    # Parts are ranges of (name, value), so there are no more rows than parts and columns together.
    sizes: dict[str, dict[int, int]] = {c: {} for c in cuts}
    for r in placed.groupBy("name", PART).agg(F.sum("n").alias("n")).collect():
        sizes[r["name"]][r[PART]] = r["n"]
    targets = []
    for name, parts in sizes.items():
        starts, total = part_starts(parts), sum(parts.values())
        for prob in probs:
            rank = max(math.ceil(total * Decimal(str(prob))), 1)
            part = bisect.bisect_left(starts, rank) - 1
            targets.append((name, part, float(prob), rank - starts[part]))
    wanted = df.sparkSession.createDataFrame(targets, f"name string, {PART} int, prob double, rank long")
    upto = F.sum("n").over(Window.partitionBy("name", "prob").orderBy("value"))
    found = (
        placed.join(F.broadcast(wanted), ["name", PART])
        .withColumn("upto", upto)
        .filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        .select("name", "prob", "value")
        .collect()
    )
    values = {(r["name"], r["prob"]): r["value"] for r in found}
    return {c: [values[c, float(p)] for p in probs] for c in cuts}
