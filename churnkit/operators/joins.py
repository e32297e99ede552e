"""Joins that stay whole and balanced when one key dominates."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.operators.order import moves_rows
from churnkit.scratch import materialize
from churnkit.together import together

_LEFT_SALT, _RIGHT_SALT = "_left_salt", "_right_salt"
# Keys that a sketch looks for, and items it tracks; both bound its size. Missing one changes the plan, not the rows.
_MAX_HOT = 200
_TRACKED = 20_000
_MOST_SALTS = 4096


def _fingerprint(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> dict[int, int]:
    """Keys with more than two tasks' share of the rows: hash of the key, and the number of tasks it should fill.

    ``tasks`` is the number of shuffle partitions unless given. Sketches are combined in two levels, per group of
    input tasks and then over the groups, so that no task merges those of all others.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, math.isqrt(tasks))
    parts = (
        df.select(_fingerprint(keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(groups)).alias("g"))
        .groupBy("g")
        .agg(F.expr(f"approx_top_k_accumulate(h, {_TRACKED})").alias("s"), F.count("*").alias("n"))
    )
    row = parts.agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {_TRACKED}), {_MAX_HOT})").alias("top"), F.sum("n").alias("n")
    ).first()
    return {
        item["item"]: min(_MOST_SALTS, math.ceil(item["count"] * tasks / row["n"]))
        for item in row["top"] or []
        if item["count"] * tasks > 2 * row["n"]
    }


def hot_fingerprints(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> list[int]:
    return list(hot_keys(df, keys, tasks))


def _salts(hot: Mapping[int, int], keys: Sequence[str]) -> Column:
    """Number of salts of a row's key; 1 if it is not hot."""
    if not hot:
        return F.lit(1)
    listed = ", ".join(f"{h}L, {n}" for h, n in hot.items())
    return F.coalesce(F.expr(f"element_at(map({listed}), xxhash64({', '.join(f'`{k}`' for k in keys)}))"), F.lit(1))


def _own(salts: Column) -> Column:
    """A salt by the row's place in the files it is read from: rows that are alike spread as well as others."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), salts).cast("int")


def _every(salts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), salts - 1))


def _costly(df: DataFrame) -> bool:
    """Whether reading the frame again means joining or aggregating again."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(word in plan for word in ("Join", "Aggregate", "Window", "Generate"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Inner or left equi-join that spreads keys which are hot on either side, or on both.

    A hot key's rows are dealt over as many salts as its share of the rows asks for, and the other side's rows of that key
    are repeated for each salt. Rows are dealt by their place in their files, so that a retried task makes the same choice and equal
    rows spread; a side that comes out of a shuffle or costs a join or aggregate is written first. A key that is hot
    on the right is there, so an inner join serves a left join for it.
    """
    if how not in ("left", "inner"):
        raise ValueError("salting keeps results whole for left and inner joins only")
    if not null_safe:
        # A null key finds nothing.
        right = right.dropna(subset=list(on))
        left = left.dropna(subset=list(on)) if how == "inner" else left
    left, right = (materialize(side, "join") if _costly(side) or moves_rows(side) else side for side in (left, right))
    hot = together(
        left.sparkSession, {"left": lambda: hot_keys(left, on, tasks), "right": lambda: hot_keys(right, on, tasks)}
    )
    hot_left, hot_right = hot["left"], hot["right"]
    names_left, rest = left.columns, [c for c in right.columns if c not in on]
    kinds = dict(right.dtypes)

    def joined(a: DataFrame, b: DataFrame, kind: str, salts: Sequence[str] = ()) -> DataFrame:
        names = {c: f"_right_{c}" for c in (*on, *salts)}
        b = b.withColumnsRenamed(names)
        equal = [
            F.col(c).eqNullSafe(F.col(n)) if null_safe and c in on else F.col(c) == F.col(n) for c, n in names.items()
        ]
        return a.join(b, reduce(lambda x, y: x & y, equal), kind).select(*names_left, *rest)

    if not hot_left and not hot_right:
        return joined(left, right, how)
    of_left, of_right = _salts(hot_left, on), _salts(hot_right, on)
    left = left.withColumn(_LEFT_SALT, _own(of_left) if hot_left else F.lit(0))
    right = right.withColumn(_RIGHT_SALT, _own(of_right) if hot_right else F.lit(0))
    is_hot = of_right > 1
    cool_left, cool_right = left.where(~is_hot), right.where(~is_hot).withColumn(_LEFT_SALT, _every(of_left))
    out = joined(cool_left, cool_right.drop(_RIGHT_SALT), how, [_LEFT_SALT])
    if hot_right:
        # Left rows meet every right salt, right rows every left salt: each pair in one cell.
        a = left.where(is_hot).withColumn(_RIGHT_SALT, _every(of_right))
        b = right.where(is_hot).withColumn(_LEFT_SALT, _every(of_left))
        out = out.unionAll(joined(a, b, "inner", [_LEFT_SALT, _RIGHT_SALT]))
        if how == "left":
            # Only a key whose hash is that of a hot one can be missing there; there are no more such keys than hot ones.
            there = F.broadcast(right.where(is_hot).select(*on).distinct())
            same = [left[c].eqNullSafe(there[c]) for c in on]
            missing = left.where(is_hot).join(there, reduce(lambda x, y: x & y, same), "left_anti")
            gaps = [F.lit(None).cast(kinds[c]).alias(c) for c in rest]
            out = out.unionAll(missing.drop(_LEFT_SALT).select("*", *gaps))
    return out


def measured_bytes(df: DataFrame) -> int:
    """Size of the data: eight bytes per value, text by its length."""
    texts = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    row = df.agg(F.count("*").alias("n"), reduce(lambda a, b: a + b, texts, F.lit(0)).alias("text")).first()
    return 8 * len(df.columns) * row["n"] + row["text"]


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    take: Sequence[str],
    null_safe: bool = False,
    max_broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Left join that takes columns of a dimension; both sides name the key columns alike.

    The needed columns of the dimension are measured first: up to ``max_broadcast_bytes`` they are
    broadcast, beyond that the join shuffles with hot keys salted. A null key finds nothing unless
    ``null_safe``.
    """
    small = dim.select(*on, *take)
    if measured_bytes(small) > max_broadcast_bytes:
        return salted_join(df, small, on, null_safe=null_safe)
    small = F.broadcast(small)
    if not null_safe:
        return df.join(small, list(on), "left")
    renamed = small.withColumnsRenamed({c: f"_dim_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_dim_{c}")) for c in on])
    return df.join(renamed, same, "left").drop(*[f"_dim_{c}" for c in on])


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi-join of any two tables; keys that are hot on either side are spread."""
    return salted_join(left, right, on, "inner")


def left_chain(first: DataFrame, *others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left-join every other frame to the first on the same key; one shuffle per frame."""
    return reduce(lambda a, b: a.join(b, list(on), "left"), others, first)


def key_set_diff(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys found on one side only, with the side; null is a key like any other.

    A union and one aggregation: combined before the shuffle, so repeated keys cost nothing there.
    """

    def marked(df: DataFrame, in_left: bool) -> DataFrame:
        return df.select(*on, F.lit(in_left).alias("l"), F.lit(not in_left).alias("r"))

    sides = marked(left, True).union(marked(right, False))
    found = sides.groupBy(*on).agg(F.bool_or("l").alias("l"), F.bool_or("r").alias("r"))
    return found.filter(F.col("l") != F.col("r")).select(
        *on, F.when(F.col("l"), "left").otherwise("right").alias("only_in")
    )


def same_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> bool:
    return key_set_diff(left, right, on).isEmpty()
