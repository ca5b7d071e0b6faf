"""Spark SQL over the registered tables agrees with the library's DataFrame functions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from taxaspark import schemas
from taxaspark.operators.staging import write_table
from taxaspark.plans import jobs as P
from taxaspark.plans import queries as Q
from bench_views.frames import Fixtures
from testdata_paths import SF_MID


@pytest.fixture(scope="module")
def warehouse(spark):
    import tempfile
    wh = tempfile.mkdtemp(prefix="taxaspark-wh-")
    fx = Fixtures(spark, SF_MID)
    for name, ds in schemas.DATASETS.items():
        write_table(fx.staged(name), f"{wh}/{ds.stg_table}")
    fx.sample_map.write.parquet(f"{wh}/{schemas.SAMPLE_MAP_TABLE}")
    assert len(P.register_tables(spark, wh)) == 6
    return wh


def same(a, b):
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return a.columns == b.columns and rows(a) == rows(b)


def test_top_markers_sql(spark, warehouse):
    sql = spark.sql("""
        select marker_id, count(distinct sample_id) as sample_count, round(avg(abundance), 6) as avg_abundance,
               max(abundance) as max_abundance, min(abundance) as min_abundance
        from stg_marker_abundance group by marker_id
        order by avg(abundance) desc, marker_id limit 20""")
    assert same(sql, Q.top_markers_by_mean(spark.table("stg_marker_abundance")))


def test_presence_comparison_sql(spark, warehouse):
    ids = [hashlib.md5(str(i).encode()).hexdigest() for i in range(1, 400)]
    sql = spark.sql("""
        select marker_id, count(*) as present_in_samples,
               string_agg(sample_id, ',') within group (order by sample_id) as samples_with_marker
        from stg_marker_presence where presence = 1 and array_contains(:ids, sample_id)
        group by marker_id having count(*) > 1
        order by 2 desc, 1""", args={"ids": F.array(*[F.lit(i) for i in ids])})
    lib = Q.marker_presence_comparison(spark.table("stg_marker_presence"), ids)
    assert sql.count() > 0 and same(sql, lib)


def test_study_join_sql(spark, warehouse):
    sql = spark.sql("""
        with per_sample as (select sample_id, count(distinct marker_id) as n from stg_marker_abundance group by sample_id)
        select m.sample_id, run_ids, sample_name, study_name, coalesce(n, 0L) as marker_count
        from (select * from src_sample_id_map where study_name in ('5-LOW', '3-MEDIUM')) m
        left join per_sample p on p.sample_id = m.sample_id
        order by marker_count desc, m.sample_id""")
    lib = Q.study_samples_marker_counts(spark.table("src_sample_id_map"), spark.table("stg_marker_abundance"),
                                        ["5-LOW", "3-MEDIUM"])
    assert same(sql, lib)


def test_sampling_and_approx_sql(spark, warehouse):
    n = spark.sql("select count(*) from stg_marker_abundance tablesample (1 percent) repeatable (7)").first()[0]
    total = spark.table("stg_marker_abundance").count()
    assert 0 < n < 0.05 * total
    approx = spark.sql("select approx_count_distinct(sample_id) from stg_marker_abundance").first()[0]
    exact = spark.table("stg_marker_abundance").select("sample_id").distinct().count()
    assert abs(approx - exact) <= 0.15 * exact
