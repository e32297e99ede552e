"""Row-wise rules at their edges."""

import pytest
from pyspark.sql import functions as F

from churnkit.functions import (
    at_most_one_ratio,
    map_values,
    number_or,
    prefix_class,
    ratio_or,
    rule_points,
    snake_case,
    tier,
)
from churnkit.plans import values as v
from churnkit.plans.scoring import with_score
from churnkit.plans.silver import add_row_features


def column(spark, expr, values, kind):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("out")).collect()]


@pytest.mark.parametrize(
    "steps, rest, values, expected",
    [
        (v.QUALITY_STEPS, v.QUALITY_REST, [0.0, 0.02, 0.021, 0.05, 0.051, 0.07, 0.071, None],
         ["Excellent", "Excellent", "Good", "Good", "Poor", "Poor", "Very Poor", "Very Poor"]),
        (v.REVENUE_CHANGE_STEPS, v.REVENUE_CHANGE_REST, [-20.0, -19.9, -5.1, -5.0, 5.0, 5.1, 20.0, 20.1, None],
         ["Significant Drop", "Slight Drop", "Slight Drop", "Stable", "Stable", "Slight Increase",
          "Slight Increase", "Significant Increase", "Significant Increase"]),
        (v.LOYALTY_STEPS, v.LOYALTY_REST, [6.0, 7.0, 12.0, 13.0, 24.0, 25.0],
         ["newcomer", "mid_term", "mid_term", "loyal", "loyal", "veteran"]),
        (v.HOUSEHOLD_STEPS, v.HOUSEHOLD_REST, [0.0, 1.0, 2.0, 3.0, 4.0],
         ["Unknown", "Single", "Small Family", "Small Family", "Big Family"]),
        (v.DEVICE_AGE_STEPS, v.DEVICE_AGE_REST, [365.0, 366.0, 730.0, 731.0], ["New", "Mid-Age", "Mid-Age", "Old"]),
        (v.OVERAGE_STEPS, v.OVERAGE_REST, [0.01, 0.02, 0.1, 0.11, 0.3, 0.31],
         ["No Overage", "Light Overage", "Light Overage", "Medium Overage", "Medium Overage", "Heavy Overage"]),
        (v.RISK_STEPS, v.RISK_REST, [100.0, 60.0, 59.0, 30.0, 29.0], ["High", "High", "Medium", "Medium", "Low"]),
    ],
)
def test_tiers(spark, steps, rest, values, expected):
    assert column(spark, tier("x", steps, rest), values, "double") == expected


def test_ratios(spark):
    rows = [(1.0, 0.0), (1.0, -1.0), (3.0, 2.0), (1.0, 3.0), (None, 2.0), (1.0, None), (23.0, 40.0)]
    df = spark.createDataFrame(rows, "n double, d double")
    out = df.select(ratio_or("n", "d").alias("r"), at_most_one_ratio("n", "d").alias("c")).collect()
    assert [r.r for r in out] == [0.0, 0.0, 1.5, 0.33, None, 0.0, 0.58]
    assert [r.c for r in out] == [0.0, 0.0, 1.0, 0.33, None, 0.0, 0.58]


def test_value_map_and_prefix(spark):
    values = ["Y", "N", "y", "", None]
    assert column(spark, map_values("x", v.ASL_LABELS), values, "string") == ["Yes", "No", None, None, None]
    assert column(spark, map_values("x", {"Y": "Yes"}, "Other"), values, "string") == ["Yes"] + ["Other"] * 4
    codes = ["A1", "ZZ", "F", "", None]
    assert column(spark, prefix_class("x", v.CREDIT_CLASSES, v.CREDIT_OTHER), codes, "string") == [
        "Class A", "Class Z", "Class Other", "Class Other", "Class Other"
    ]


def test_numbers_from_text(spark):
    values = [" 12 ", "1.5", "x", "", None]
    assert column(spark, number_or("x", "int"), values, "string") == [12, 0, 0, 0, 0]
    assert column(spark, number_or("x", "double", 0.0), values, "string") == [12.0, 1.5, 0.0, 0.0, 0.0]


def test_score_ignores_missing_measures(spark):
    fields = "customer_id string, anger_rate int, resolved string, dropped_calls int, outage_flag int, package_usage_pct int"
    rows = [("all", 8, "No", 3, 1, 19), ("none", None, None, None, None, None), ("edge", 7, "Yes", 2, 0, 20)]
    out = {r.customer_id: r for r in with_score(spark.createDataFrame(rows, fields)).collect()}
    assert [(out[c].churn_score, out[c].risk_level) for c in ("all", "none", "edge")] == [
        (100, "High"), (0, "Low"), (0, "Low")
    ]
    assert out["all"].churn_score == sum(points for *_, points in v.SCORE_RULES)
    assert str(rule_points(v.SCORE_RULES)).count("CASE WHEN") == len(v.SCORE_RULES)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Customer_ID", "customer_id"), ("rev_Mean", "rev_mean"), ("HHstatin", "hhstatin"),
        ("kid0_2", "kid0_2"), ("_pipeline_run_ts", "pipeline_run_ts"), ("runTsUTC", "run_ts_utc"),
        ("a b--c", "a_b_c"), ("aB1c2D", "a_b1c2_d"), ("x1Y", "x1_y"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_no_data_usage_label(spark):
    names = "asl_flag refurb_new prizm_social_one crclscod".split()
    numbers = """totrev adjrev ovrrev_mean totmrc_mean roam_mean change_rev months adults eqpdays comp_vce_mean
    plcd_vce_mean blck_vce_mean drop_blk_mean attempt_mean unan_dat_mean plcd_dat_mean""".split()
    df = spark.range(2).select(
        *[F.lit("N").alias(n) for n in names], *[F.col("id").cast("double").alias(n) for n in numbers]
    )
    out = add_row_features(df).orderBy("plcd_dat_mean").collect()
    assert [r.data_experience for r in out] == ["No Data Usage", "Very Poor"]
    assert [r.data_failure_rate for r in out] == [0.0, 1.0]
