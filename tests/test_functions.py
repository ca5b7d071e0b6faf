"""Scalar semantics: lenient casts, NULL on no match, NaN handling, string_agg."""

import math

from pyspark.sql import functions as F

from taxaspark.functions.columns import (
    gt_not_nan, lenient_double, lenient_long, min_nan_first, ordered_string_agg, sample_id_from_path,
)
from taxaspark.plans.queries import nan_low


def one_col(spark, values, ddl="x string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_lenient_double(spark):
    vals = ["1.5", "1.0d", "2F", "1e3", "inf", "NaN", "abc", "", None, "-", "3d\t", " 7.f ", "-Infinity"]
    got = [r[0] for r in one_col(spark, vals).select(lenient_double("x")).collect()]
    assert got[:5] == [1.5, None, None, 1000.0, float("inf")]
    assert math.isnan(got[5])
    assert got[6:] == [None, None, None, None, None, None, float("-inf")]


def test_lenient_long(spark):
    vals = ["12", "1.5", "0x1F", "-0x10", "abc", "9223372036854775808", "1e3", None, "\t-0X1a ", "x12"]
    got = [r[0] for r in one_col(spark, vals).select(lenient_long("x")).collect()]
    assert got == [12, None, 31, -16, None, None, None, None, -26, None]


def test_typed_input_is_passed_through(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(lenient_double("x", df.schema["x"].dataType)).collect()] == [1.5, None]


def test_sample_id_from_path(spark):
    from taxaspark.schemas import DEFAULT_RUN_TAG as tag
    df = one_col(spark, [f"gs://b/results/{tag}/abc/metaphlan_markers/f.tsv.gz", "gs://b/other/abc/f.tsv.gz"])
    assert [r[0] for r in df.select(sample_id_from_path("x")).collect()] == ["abc", None]
    assert [r[0] for r in df.select(sample_id_from_path("x", "other")).collect()] == [None, "abc"]


def test_nan_comparison_and_min(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 20.0), ("b", 5.0), ("b", 30.0)], "k string, v double")
    assert sorted(r.v for r in df.where(gt_not_nan("v", 10.0)).collect()) == [20.0, 30.0]
    mins = {r.k: r.m for r in df.groupBy("k").agg(min_nan_first("v").alias("m")).collect()}
    assert math.isnan(mins["a"]) and mins["b"] == 5.0


def test_ordered_string_agg(spark):
    df = spark.createDataFrame([("a", "z"), ("a", None), ("a", "b"), ("c", None)], "k string, v string")
    got = {r.k: r.s for r in df.groupBy("k").agg(ordered_string_agg("v").alias("s")).collect()}
    assert got == {"a": "b,z", "c": None}


def test_nan_low_sort(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    desc = [r.v for r in df.orderBy(*nan_low("v", ascending=False)).collect()]
    assert desc[:2] == [3.0, 1.0] and math.isnan(desc[2]) and desc[3] is None
    asc = [r.v for r in df.orderBy(*nan_low("v", ascending=True)).collect()]
    assert asc[0] is None and math.isnan(asc[1]) and asc[2:] == [1.0, 3.0]


def test_like_is_a_pattern_not_a_prefix(spark):
    df = one_col(spark, ["k__Bacteria", "kXYfoo", "k__B|p__F", "p__F"])
    assert [r.x for r in df.where(F.col("x").like("k__%")).collect()] == ["k__Bacteria", "kXYfoo", "k__B|p__F"]
    kingdom = df.where(F.col("x").like("k__%") & ~F.col("x").like("k__%|%"))
    assert [r.x for r in kingdom.collect()] == ["k__Bacteria", "kXYfoo"]
