"""Cleaning on small frames with the edges the tables lack."""

from churnkit.operators import (
    cap_two_sided,
    cap_upper,
    clamp_negative,
    coerce_numbers,
    column_modes,
    drop_exact_duplicates,
    impute_median,
    impute_mode,
    keep_labels,
    missing_counts,
    one_row_per_key,
    outlier_columns,
    outlier_shares,
    quantile_bins,
    require_rows,
)
from churnkit.operators.stats import any_negative

import pytest


def test_all_null_columns(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, t string")
    filled = impute_mode(impute_median(df, ["x"]), ["t"])
    assert filled.distinct().collect() == [(0.0, "Unknown")]
    assert impute_median(df, ["x"], rel_error=0).distinct().collect()[0].x == 0.0
    assert outlier_shares(df, ["x"]) == {}
    assert quantile_bins(df, "x", "b").first().b == "High"


def test_median_into_int_column_keeps_type(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    filled = impute_median(df, ["x"], rel_error=0)
    assert filled.dtypes == [("x", "int")]
    assert sorted(r.x for r in filled.collect()) == [1, 1, 3]


def test_mode_ties_blanks_and_spaces(spark):
    rows = [("a",), ("a",), ("c",), ("c",), ("b",), ("",), ("",), ("",), (None,), ("  ",)]
    df = spark.createDataFrame(rows, "t string")
    assert column_modes(df, ["t"]) == {"t": "a"}
    kept = sorted(r.t for r in impute_mode(df, ["t"]).collect())
    assert kept == ["", "", "", "  ", "a", "a", "a", "b", "c", "c"]
    replaced = sorted(r.t for r in impute_mode(df, ["t"], treat_empty_as_null=True).collect())
    assert replaced == ["  ", "a", "a", "a", "a", "a", "a", "b", "c", "c"]
    assert missing_counts(df).first().t == 4


def test_duplicate_key_with_bad_and_good_label(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (2, 7), (3, None), (1, 0)], "k int, churn int")
    first = one_row_per_key(keep_labels(df, "churn"), ["k"]).collect()
    assert [tuple(r) for r in first] == [(1, 0)]
    assert drop_exact_duplicates(df).count() == 4
    ordered = one_row_per_key(df, ["k"], [df.churn.desc_nulls_last()]).collect()
    assert sorted((r.k, r.churn) for r in ordered if r.k != 3) == [(1, 2), (2, 7)]


def test_clamp_keeps_type_and_null(spark):
    df = spark.createDataFrame([(-1, -0.5), (2, None)], "i int, d double")
    out = clamp_negative(df, ["i", "d"])
    assert out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect())) == [(0, 0.0), (2, None)]
    assert any_negative(df, ["i", "d"]) == ["i", "d"]
    assert any_negative(out, ["i", "d"]) == []


def test_caps_stay_within_quantiles(spark):
    df = spark.range(1, 1001).selectExpr("id AS x", "CASE WHEN id = 1 THEN NULL ELSE double(id) END AS d")
    upper = cap_upper(df, ["x"], rel_error=0)
    assert upper.dtypes == df.dtypes
    assert upper.agg({"x": "max"}).first()[0] == 990
    both = cap_two_sided(df, ["x", "d"], rel_error=0)
    assert both.selectExpr("min(x)", "max(x)").first() == (10, 990)
    assert both.filter("d IS NULL").count() == 1


def test_outliers_count_nulls_as_rows(spark):
    rows = [(float(i % 5),) for i in range(90)] + [(100.0,)] * 2 + [(None,)] * 8
    df = spark.createDataFrame(rows, "x double")
    assert outlier_shares(df, ["x"], rel_error=0) == {"x": 0.02}
    assert outlier_columns(df, ["x"], rel_error=0) == ["x"]
    assert outlier_columns(df, ["x"], ratio=0.02, rel_error=0) == []


def test_coerce_trims_and_defaults(spark):
    df = spark.createDataFrame([(" a ", "1.5", " 7", 3), ("b", "?", "", 4)], "t string, d string, i string, n int")
    out = coerce_numbers(df, ["d"], ["i"])
    assert [tuple(r) for r in out.collect()] == [("a", 1.5, 7, 3), ("b", 0.0, 0, 4)]


def test_gate(spark):
    assert require_rows(spark.range(3), "r") == 3
    with pytest.raises(ValueError, match="empty one"):
        require_rows(spark.range(0), "empty one")
