"""Pivot, sampling, checks and catalog operators."""

import pytest
from pyspark.sql import functions as F

from taxaspark.operators.catalog import TABLE, VIEW, TableEntry, catalog_summary, schema_catalog, table_profile
from taxaspark.operators.checks import duplicate_keys, key_check, layer_counts
from taxaspark.operators.pivot import pivot_wide
from taxaspark.operators.sampling import sample_keys
from bench_views.frames import Fixtures
from taxaspark.plans.queries import approx_distinct_samples, kingdom_composition_wide
from testdata_paths import SF_MID, SF_SMALL

LONG = "sample_id string, clade_name string, relative_abundance double"


def test_pivot_unique_cells(spark):
    df = spark.createDataFrame([("s1", "k__A", 1.0), ("s1", "k__B", 2.0), ("s2", "k__A", 3.0)], LONG)
    wide = pivot_wide(df, "sample_id", "clade_name", "relative_abundance")
    out = {r.sample_id: r.asDict() for r in wide.collect()}
    assert out["s1"]["k__A"] == 1.0 and out["s1"]["k__B"] == 2.0 and out["s2"]["k__B"] is None


def test_pivot_refuses_duplicate_cells(spark):
    df = spark.createDataFrame([("s1", "k__A", 1.0), ("s1", "k__A", 2.0)], LONG)
    with pytest.raises(Exception, match="duplicate pivot cell"):
        pivot_wide(df, "sample_id", "clade_name", "relative_abundance").collect()
    summed = pivot_wide(df, "sample_id", "clade_name", "relative_abundance", cell="sum").first()
    assert summed["k__A"] == 3.0


def test_fixture_kingdom_pivot_has_duplicates(spark):
    rel = Fixtures(spark, SF_MID).rel_ab
    with pytest.raises(Exception, match="duplicate pivot cell"):
        kingdom_composition_wide(rel, cell="unique", samples=rel.select("sample_id").distinct()).collect()


def test_sample_keys_takes_whole_samples(spark):
    ab = Fixtures(spark, SF_MID).staged("marker_abundance")
    picked = sample_keys(ab, 10.0)
    per = picked.groupBy("sample_id").count().alias("p").join(ab.groupBy("sample_id").count().alias("a"),
                                                              "sample_id")
    assert per.where(F.col("p.count") != F.col("a.count")).count() == 0
    n, total = picked.select("sample_id").distinct().count(), ab.select("sample_id").distinct().count()
    assert 0.05 * total < n < 0.15 * total


def test_approx_distinct_within_bound(spark):
    ab = Fixtures(spark, SF_MID).staged("marker_abundance")
    exact = ab.select("sample_id").distinct().count()
    approx = approx_distinct_samples(ab, 0.05).first()[0]
    assert abs(approx - exact) <= 3 * 0.05 * exact


def test_layer_counts_and_key_check(spark):
    a = spark.createDataFrame([("s1",), (None,), ("s2",), ("s2",)], "sample_id string")
    b = a.where(F.col("sample_id").isNotNull())
    rows = [tuple(r) for r in layer_counts([("src", a), ("stg", b)]).orderBy("position").collect()]
    assert rows == [(0, "src", 4, None), (1, "stg", 3, 1)]
    kc = key_check(b, "sample_id").first()
    assert (kc.total_rows, kc.distinct_sample_ids) == (3, 2)
    assert [tuple(r) for r in duplicate_keys(b, "sample_id").collect()] == [("s2", 2)]


def test_catalog_profile_and_summary(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    p = f"{tmp_dir}/stg_marker_abundance"
    fx.staged("marker_abundance").write.parquet(p)
    t = spark.read.parquet(p)
    bad = TableEntry("stg_broken", TABLE, t, path=f"{tmp_dir}/missing")
    entries = [TableEntry("stg_marker_abundance", TABLE, t, path=p, clustering_fields=["sample_id"]),
               TableEntry("src_marker_abundance", VIEW, fx.marker_abundance, view_query="..."), bad]
    prof = {r.table_id: r for r in table_profile(spark, entries).collect()}
    assert prof["stg_marker_abundance"].num_rows == t.count()
    assert prof["stg_marker_abundance"].num_bytes > 0
    assert prof["src_marker_abundance"].num_rows is None
    assert prof["stg_broken"].error is not None
    s = catalog_summary(table_profile(spark, entries)).first()
    assert s.total_tables == 3
    assert s.by_type == {"TABLE": 1, "VIEW": 1}
    assert s.by_prefix == {"src_": 1, "stg_": 1}
    assert s.total_rows == t.count()
    cat = schema_catalog(spark, entries[:1]).collect()
    assert [(r.field_name, r.field_type, r.mode) for r in cat] == [
        ("sample_id", "STRING", "NULLABLE"), ("marker_id", "STRING", "NULLABLE"),
        ("abundance", "FLOAT", "NULLABLE")]


def test_preview_puts_provenance_first(spark):
    import __spark_entry__ as E
    df = E.queries()["K3_preview_with_provenance"](spark, SF_SMALL)
    rows = df.collect()
    assert df.columns[:2] == ["file_path", "sample_id"] and len(rows) == 3
    assert all(r.file_path.endswith(".tsv.gz") and r.file_path.startswith(r.sample_id) for r in rows)


def test_sampling_reaches_any_share(spark):
    from taxaspark.operators.sampling import key_bound, sample_keys
    df = spark.range(600_000).select(F.col("id").cast("string").alias("sample_id"))
    assert 5 <= sample_keys(df, 0.004).count() <= 60  # 24 expected
    assert key_bound(1e-9) > 0 and sample_keys(df, 100).count() == 600_000
    assert sample_keys(df, 0.5).join(sample_keys(df, 1.0), "sample_id", "left_anti").isEmpty()


def test_pivot_has_no_bound(spark):
    from taxaspark.operators.pivot import pivot_wide
    df = spark.range(2).select(F.col("id").alias("i"), F.lit("c10001").alias("c"), F.lit(1).alias("v"))
    wide = pivot_wide(df, "i", "c", "v", values=[f"c{n}" for n in range(10_002)])
    assert len(wide.columns) == 10_003 and wide.where("c10001 = 1").count() == 2


def test_whole_error_text(spark):
    def broken():
        raise ValueError("x" * 5000)
    rows = table_profile(spark, [TableEntry("t", TABLE, broken)]).collect()
    assert rows[0].error == "ValueError: " + "x" * 5000


def test_a_value_without_a_pivot_column_fails(spark):
    df = spark.createDataFrame([("s1", "a", 1.0), ("s1", None, 2.0), ("s2", "b", 3.0)], "i string, c string, v double")
    wide = pivot_wide(df, "i", "c", "v", values=["a", "b"], cell="sum")
    assert sorted(map(tuple, wide.collect())) == [("s1", 1.0, None), ("s2", None, 3.0)]
    with pytest.raises(Exception, match="without a pivot column: b"):
        pivot_wide(df, "i", "c", "v", values=["a"], cell="sum").collect()
