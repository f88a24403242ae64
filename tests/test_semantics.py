"""Numeric semantics that decide right or wrong."""

from pyspark.sql import functions as F

from postlens.functions.semantics import at_least, band, bool_mean, clip, labels, np_round, pct_change, safe_div
from postlens.operators import postal as O


def one(spark, expr, value=None, schema="x double"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_round_half_even_like_pandas(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (0.135,), (None,)], "x double")
    got = [r["r"] for r in df.select(np_round("x", 2).alias("r")).collect()]
    assert got == [0.12, 2.68, 1.0, 0.14, None]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (130.0,), (60.0,)], "x double")
    assert [r["r"] for r in df.select(clip("x", 0, 120).alias("r")).collect()] == [None, 0.0, 120.0, 60.0]


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r["r"] for r in df.select(safe_div("a", "b").alias("r")).collect()] == [None, None, 1.5]


def test_pct_change(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0)], "a double, b double")
    got = [r["r"] for r in df.select(pct_change("a", "b").alias("r")).collect()]
    assert abs(got[0] - 10.0) < 1e-9 and got[1] is None


def test_sentiment_bounds_inclusive(spark):
    df = spark.createDataFrame([(s,) for s in (None, 3, 4, 5, 6, 7, 8)], "s int")
    mvp = [r["r"] for r in df.select(O.sentiment_band("s", 7, 4).alias("r")).collect()]
    ml = [r["r"] for r in df.select(O.sentiment_band("s", 8, 4).alias("r")).collect()]
    assert mvp == [None, "negative", "negative", "neutral", "neutral", "positive", "positive"]
    assert ml == [None, "negative", "negative", "neutral", "neutral", "neutral", "positive"]


def test_trend_strict_bounds(spark):
    df = spark.createDataFrame([(c,) for c in (-10.0, -10.0001, 10.0, 10.0001, None)], "c double")
    got = [r["r"] for r in df.select(O.performance_trend("c").alias("r")).collect()]
    assert got == ["stable", "improving", "stable", "declining", None]


def test_expansion_priority_edges(spark):
    df = spark.createDataFrame([(r,) for r in (1.0999, 1.1, 1.2999, 1.3, None)], "r double")
    got = [r["p"] for r in df.select(O.expansion_priority("r").alias("p")).collect()]
    assert got == ["high", "medium", "medium", "low", None]


def test_bottlenecks_order_and_equality(spark):
    df = spark.createDataFrame([(61.0, 0.06, 299.0), (60.0, 0.05, 300.0)], "a double, e double, t double")
    got = [r["b"] for r in df.select(O.department_bottlenecks("a", "e", "t").alias("b")).collect()]
    assert got == [["slow_processing", "high_error_rate", "low_throughput"], []]


def test_coverage_gaps(spark):
    df = spark.createDataFrame([(0.69, 7.9), (0.7, 8.0)], "d double, q double")
    got = [r["g"] for r in df.select(O.coverage_gaps("d", "q").alias("g")).collect()]
    assert got == [["low_department_density", "service_quality_issues"], []]


def test_staff_floor_and_bool_mean(spark):
    df = spark.createDataFrame([(0,), (3,), (None,)], "n int")
    assert [r["r"] for r in df.select(at_least("n", 1).alias("r")).collect()] == [1, 3, None]
    b = spark.createDataFrame([(True,), (False,), (True,), (None,)], "b boolean")
    assert abs(b.agg(bool_mean("b").alias("m")).first()["m"] - 2 / 3) < 1e-12


def test_labels_empty_array(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert df.select(labels((F.col("x") > 5, "big")).alias("l")).first()["l"] == []


def test_band_null_first(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(band("x", [("<", 1.0, "a")], "b").alias("r")).first()["r"] is None


def test_courier_efficiency_rounding(spark):
    df = spark.createDataFrame([(50.0, 0.9), (0.0, 0.9)], "t double, s double")
    got = [r["e"] for r in df.select(O.courier_efficiency("t", "s").alias("e")).collect()]
    assert got == [1.8, None]


def test_padded_ids_are_never_cut(spark):
    from postlens.functions.semantics import padded_id
    keys = [7, 99_999, 100_000, 100_001, 100_002, 1_000_000, 10**9, 10**12]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r.i for r in df.orderBy("k").select(padded_id("CUR_", "k", 5).alias("i")).collect()]
    assert got == [f"CUR_{k:05d}" for k in keys]


def test_one_row_summaries_must_not_share_columns(spark):
    import pytest
    from postlens.operators.common import side_by_side
    a = spark.createDataFrame([(1, 2)], "a long, b long")
    with pytest.raises(ValueError, match="b"):
        side_by_side(a, a.select("b"))
