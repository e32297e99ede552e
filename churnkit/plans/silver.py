"""Batch plan: client and record files to the silver table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.names import snake_case
from churnkit.functions.rules import (
    at_most_one_ratio,
    flag,
    map_values,
    prefix_class,
    ratio_or,
    tier,
)
from churnkit.operators import clean
from churnkit.operators.features import quantile_bins
from churnkit.operators.ranks import quantiles
from churnkit.operators.project import add_run_columns, keep_columns, rename_snake_case
from churnkit.operators.stats import numeric_columns, text_columns
from churnkit.plans import values as v
from churnkit.scratch import materialize

KEY = snake_case(v.CUSTOMER)


def focus(
    client: DataFrame,
    record: DataFrame,
    run_ts: datetime | None = None,
    filter_first: bool = True,
) -> DataFrame:
    """Joined, narrowed and renamed rows, one per customer with a valid label.

    Both sides are cut to one row per customer before the join, so a customer with many copies
    never multiplies; the join then reuses the partitioning of that step. ``filter_first`` drops
    bad labels before a row is chosen; otherwise a customer whose chosen row has one is lost.
    """
    kept = set(v.KEPT_COLUMNS)
    client = client.select(*[c for c in client.columns if c in kept]).filter(F.col(v.CUSTOMER).isNotNull())
    record = record.select(*[c for c in record.columns if c in kept]).filter(F.col(v.CUSTOMER).isNotNull())
    if filter_first:
        record = clean.keep_labels(record, v.LABEL)
    # Both sides hold each key once and are partitioned by it, so a plain join is balanced.
    joined = clean.one_row_per_key(client, [v.CUSTOMER]).join(
        clean.one_row_per_key(record, [v.CUSTOMER]), [v.CUSTOMER]
    )
    if not filter_first:
        joined = clean.keep_labels(joined, v.LABEL)
    stamped = add_run_columns(joined, v.RUN_VERSION, v.RUN_SOURCE, run_ts, v.RUN_ZONE)
    run_columns = [c for c in stamped.columns if c not in joined.columns]
    return rename_snake_case(keep_columns(stamped, [*v.KEPT_COLUMNS, *run_columns]))


def signed(columns: list[str]) -> list[str]:
    """Columns that may be negative by nature."""
    return [c for c in columns if v.SIGNED_MARK in c]


def impute(df: DataFrame, rel_error: float = v.QUANTILE_ERROR) -> DataFrame:
    """Clamp, fill and normalise."""
    numbers = numeric_columns(df, exclude=(v.LABEL, KEY))
    texts = text_columns(df, exclude=tuple(v.CONSTANT_FILL))
    clamped = clean.clamp_negative(df, [c for c in numbers if c not in signed(numbers)])
    filled = clean.impute_median(clamped, [c for c in numbers if c not in v.CONSTANT_FILL], rel_error)
    filled = clean.impute_mode(filled, texts, v.NO_TEXT)
    filled = clean.impute_constants(filled, v.CONSTANT_FILL)
    return clean.normalize_text(filled, texts)


def cap_and_bin(df: DataFrame, rel_error: float = v.CAP_ERROR) -> DataFrame:
    """Cap the columns with many outliers and add the revenue bins, from one quantile pass.

    The label takes part in the outlier test, the key does not. Capping keeps the order of values,
    so the quartiles of the capped revenue are the capped quartiles.
    """
    columns = numeric_columns(df, exclude=(KEY,))
    marks = quantiles(df, columns, [0.01, 0.25, 0.5, 0.75, 0.99], rel_error)
    quartiles = {c: [m[1], m[3]] if m else [] for c, m in marks.items()}
    chosen = clean.outlier_columns(df, columns, v.OUTLIER_RATIO, quartiles=quartiles)
    both = signed(chosen)
    bounds = {c: (marks[c][0] if c in both else None, marks[c][4]) for c in chosen}
    cuts = marks[v.VALUE_COLUMN][1:4]
    if v.VALUE_COLUMN in bounds:
        cuts = [min(cut, bounds[v.VALUE_COLUMN][1]) for cut in cuts]
    return quantile_bins(clean.cap(df, bounds), v.VALUE_COLUMN, v.VALUE_SEGMENT, cuts=cuts)


def add_row_features(df: DataFrame) -> DataFrame:
    """All features that need only their own row."""
    df = df.withColumns(
        {
            "asl_flag": map_values("asl_flag", v.ASL_LABELS),
            "refurb_new": map_values("refurb_new", v.REFURB_LABELS),
            "prizm_social_mapped": map_values("prizm_social_one", v.SOCIAL_LABELS, v.SOCIAL_OTHER),
            "crclscod_bin": prefix_class("crclscod", v.CREDIT_CLASSES, v.CREDIT_OTHER),
            "refunds": F.round(F.col("totrev") - F.col("adjrev"), 2),
            "overage_flag": flag(F.col("ovrrev_mean") > 0),
            "overage_rate": ratio_or("ovrrev_mean", "totmrc_mean"),
            "is_roamer": flag(F.col("roam_mean") > 0),
            "customer_status": tier("change_rev", v.REVENUE_CHANGE_STEPS, v.REVENUE_CHANGE_REST),
            "customer_loyalty": tier("months", v.LOYALTY_STEPS, v.LOYALTY_REST),
            "household_segment": tier("adults", v.HOUSEHOLD_STEPS, v.HOUSEHOLD_REST),
            "device_age": tier("eqpdays", v.DEVICE_AGE_STEPS, v.DEVICE_AGE_REST),
            "completed_call_rate": at_most_one_ratio("comp_vce_mean", "plcd_vce_mean"),
            "blocked_call_rate": at_most_one_ratio("blck_vce_mean", "plcd_vce_mean"),
            "drop_block_call_rate": at_most_one_ratio("drop_blk_mean", "attempt_mean"),
            "data_failure_rate": at_most_one_ratio("unan_dat_mean", "plcd_dat_mean"),
        }
    )
    quality_of_data = tier("data_failure_rate", v.QUALITY_STEPS, v.QUALITY_REST)
    return df.withColumns(
        {
            "overage_status": tier("overage_rate", v.OVERAGE_STEPS, v.OVERAGE_REST),
            "network_quality": tier("drop_block_call_rate", v.QUALITY_STEPS, v.QUALITY_REST),
            "data_experience": F.when(F.col("plcd_dat_mean") == 0, v.NO_DATA_LABEL).otherwise(
                quality_of_data
            ),
        }
    )


def add_features(df: DataFrame, rel_error: float = v.QUANTILE_ERROR) -> DataFrame:
    """All features of rows that are clean already."""
    return add_row_features(quantile_bins(df, v.VALUE_COLUMN, v.VALUE_SEGMENT, rel_error=rel_error))


def build_silver(
    client: DataFrame,
    record: DataFrame,
    run_ts: datetime | None = None,
    rel_error: float = v.QUANTILE_ERROR,
    cap_error: float = v.CAP_ERROR,
    filter_first: bool = True,
    path: str | None = None,
) -> DataFrame:
    """Raw files to silver (lazy from the focused table on).

    The joined table is written once; four passes over it, whatever the number of columns, find
    modes, medians, quantiles and outlier shares, each reading only the columns it needs.
    ``rel_error`` is the rank error of the medians, ``cap_error`` that of caps and bins.
    """
    focused = materialize(focus(client, record, run_ts, filter_first), "focused", path)
    imputed = impute(focused, rel_error)
    return add_row_features(cap_and_bin(imputed, cap_error))
