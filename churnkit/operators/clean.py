"""Cleaning: duplicates, labels, clamping, imputation, text, outliers and caps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.rules import number_or
from churnkit.operators.latest import first_per_key
from churnkit.operators.ranks import Marks, quantiles
from churnkit.operators.stats import column_modes, outside_share

Bounds = Mapping[str, tuple[float | None, float | None]]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """Keep the first row of each key by ``order`` (default: all other columns, ascending).

    Also drops exact duplicates, so ``drop_exact_duplicates`` is not needed before it.
    """
    if order is None:
        order = [c for c in df.columns if c not in keys]
    columns = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    return first_per_key(df, keys, columns or [F.lit(0)])


def keep_labels(df: DataFrame, label: str, allowed: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows whose label is one of ``allowed``; a null label is dropped."""
    return df.filter(F.col(label).isin(*allowed))


def _replace(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    """Swap columns in one projection, each cast back to its own type."""
    return df.select(
        *[
            changed[f.name].cast(f.dataType).alias(f.name) if f.name in changed else f.name
            for f in df.schema
        ]
    )


def clamp_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Negative values become 0; the column keeps its type."""
    return _replace(df, {c: F.when(F.col(c) < 0, 0).otherwise(F.col(c)) for c in columns})


def impute_constants(df: DataFrame, values: Mapping[str, float | int | str]) -> DataFrame:
    """Fill nulls; the value is cast to the column's type (2.7 into an int column gives 2)."""
    return df.fillna(dict(values)) if values else df


def impute_median(
    df: DataFrame, columns: Sequence[str], rel_error: float = 0.01, empty: float = 0.0
) -> DataFrame:
    """Fill nulls with the median of the column, or ``empty`` if it has no value at all."""
    medians = quantiles(df, columns, [0.5], rel_error)
    return impute_constants(df, {c: (m[0] if m else empty) for c, m in medians.items()})


def impute_mode(
    df: DataFrame,
    columns: Sequence[str],
    empty: str = "Unknown",
    treat_empty_as_null: bool = False,
) -> DataFrame:
    """Fill nulls with the most frequent text of the column.

    Empty text never counts as the mode, yet it stays in place unless ``treat_empty_as_null``.
    """
    modes = column_modes(df, columns)
    if treat_empty_as_null:
        df = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})
    return impute_constants(df, {c: modes.get(c, empty) for c in columns})


def normalize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trimmed upper case."""
    return df.withColumns({c: F.upper(F.trim(c)) for c in columns})


def coerce_numbers(
    df: DataFrame, doubles: Sequence[str] = (), integers: Sequence[str] = ()
) -> DataFrame:
    """Trim all text columns and turn the named ones into numbers, junk into 0."""
    kinds = {c: "double" for c in doubles} | {c: "int" for c in integers}
    return df.select(
        *[
            number_or(c, kinds[c]).alias(c) if c in kinds else F.trim(c).alias(c) if t == "string" else c
            for c, t in df.dtypes
        ]
    )


def outlier_shares(
    df: DataFrame,
    columns: Sequence[str],
    rel_error: float = 0.01,
    reach: float = 1.5,
    quartiles: Marks | None = None,
) -> dict[str, float]:
    """Share of rows outside ``q1 - reach*iqr .. q3 + reach*iqr``; columns without values are left out.

    ``quartiles`` (first and third of each column) spares the pass that finds them.
    """
    if quartiles is None:
        quartiles = quantiles(df, columns, [0.25, 0.75], rel_error)
    shares = {}
    for name in columns:
        if quartiles[name]:
            q1, q3 = quartiles[name]
            slack = reach * (q3 - q1)
            shares[name] = outside_share(name, q1 - slack, q3 + slack)
    if not shares:
        return {}
    row = df.agg(*[share.alias(name) for name, share in shares.items()]).first()
    return {name: row[name] for name in shares if row[name] is not None}


def outlier_columns(
    df: DataFrame,
    columns: Sequence[str],
    ratio: float = 0.01,
    rel_error: float = 0.01,
    quartiles: Marks | None = None,
) -> list[str]:
    """Columns with more than ``ratio`` of their rows outside the fences."""
    shares = outlier_shares(df, columns, rel_error, quartiles=quartiles)
    return [c for c, share in shares.items() if share > ratio]


def cap(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Pull values beyond a bound back to it; null stays null, ``None`` is no bound."""

    def capped(name: str, low: float | None, high: float | None) -> Column:
        c = F.col(name)
        out = c
        if high is not None:
            out = F.when(c > high, F.lit(high)).otherwise(out)
        if low is not None:
            out = F.when(c < low, F.lit(low)).otherwise(out)
        return out

    return _replace(df, {c: capped(c, *b) for c, b in bounds.items()})


def cap_upper(df: DataFrame, columns: Sequence[str], rel_error: float = 0.001) -> DataFrame:
    """Cap above the 99 % quantile."""
    marks = quantiles(df, columns, [0.99], rel_error)
    return cap(df, {c: (None, *m) for c, m in marks.items() if m})


def cap_two_sided(df: DataFrame, columns: Sequence[str], rel_error: float = 0.001) -> DataFrame:
    """Cap below the 1 % and above the 99 % quantile."""
    marks = quantiles(df, columns, [0.01, 0.99], rel_error)
    return cap(df, {c: tuple(m) for c, m in marks.items() if m})
