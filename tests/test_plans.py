"""Physical plans: pushdown, pruning, broadcast under a bound, no needless exchange."""

import contextlib
import io

from pyspark.sql import functions as F

from taxaspark import schemas
from taxaspark.operators import joins
from taxaspark.operators.staging import cluster, stage, write_table
from taxaspark.sources.snapshots import folder
from taxaspark.sources.tables import open_table
from taxaspark.plans import queries as Q
from taxaspark.plans.exports import export_frame
from bench_views.frames import Fixtures
from testdata_paths import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_point_lookup_is_pushed_to_parquet(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    p = f"{tmp_dir}/stg"
    write_table(fx.staged("marker_abundance"), p)
    q = Q.sample_rows_for(open_table(spark, p), "abc")
    text = plan(q)
    assert "PushedFilters: [IsNotNull(sample_id), EqualTo(sample_id,abc)]" in text


def test_projection_is_pruned(spark):
    fx = Fixtures(spark, SF_SMALL)
    text = plan(Q.marker_count_per_sample(fx.staged("marker_abundance")))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_local_layout_has_no_exchange(spark):
    fx = Fixtures(spark, SF_SMALL)
    text = plan(cluster(fx.staged("marker_abundance"), "local"))
    assert "Exchange" not in text and "Sort" in text
    text = plan(cluster(fx.staged("marker_abundance"), "range", 4))
    assert "rangepartitioning(sample_id" in text


def test_map_join_is_lazy_and_left_to_the_planner(spark):
    fx = Fixtures(spark, SF_SMALL)
    fact, sample_map = fx.staged("marker_abundance"), fx.sample_map
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    joins.join_sample_map(fact, sample_map, ["study_name"])
    joins.semi_join_keys(fact, sample_map)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs  # planning ran no job
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # no hint: a shuffle join, which AQE may turn into a broadcast by its real size
        j = joins.join_sample_map(fx.staged("marker_abundance"), fx.sample_map, ["study_name"])
        assert "SortMergeJoin" in plan(j) or "ShuffledHashJoin" in plan(j)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_top_markers_has_no_expand(spark):
    fx = Fixtures(spark, SF_SMALL)
    text = plan(Q.top_markers_by_mean(fx.staged("marker_abundance")))
    assert "Expand" not in text
    assert "TakeOrderedAndProject" in text


def test_study_counts_shrink_fact_side_before_outer_join(spark):
    fx = Fixtures(spark, SF_SMALL)
    text = plan(Q.study_samples_marker_counts(fx.sample_map, fx.staged("marker_abundance"), ["5-LOW"]))
    assert "LeftSemi" in text


def test_export_sort_is_a_range_exchange(spark):
    fx = Fixtures(spark, SF_SMALL)
    text = plan(export_frame(fx.staged("marker_abundance"), fx.sample_map, "marker_abundance"))
    assert "rangepartitioning(study_name" in text and "BroadcastHashJoin" in text


def test_raw_scan_stays_in_one_codegen_stage(spark, tmp_dir):
    import gzip
    import os
    path = os.path.join(tmp_dir, schemas.DEFAULT_RUN_TAG, "s1", schemas.MARKER_ABUNDANCE.path_tail)
    os.makedirs(os.path.dirname(path))
    with gzip.open(path, "wt") as f:
        f.write("#a\n#b\n#c\n#d\nm1\t1\n")
    from taxaspark.sources.raw import scan_src
    ab = schemas.MARKER_ABUNDANCE
    st = stage(scan_src(spark, f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", ab), ab)
    text = plan(st)
    assert "Exchange" not in text and "codegen id : 1" in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_no_python_udfs_in_queries(spark):
    import __spark_entry__ as E
    for key in ("Q2_top_markers_by_mean", "Q6_presence_comparison", "Q8_study_marker_counts",
                "Q13_kingdom_wide", "C4_lenient_casts"):
        text = plan(E.queries()[key](spark, SF_SMALL), "simple")
        assert "Python" not in text and "ArrowEval" not in text, key


def test_sample_list_from_dataframe_is_semi_join(spark):
    fx = Fixtures(spark, SF_SMALL)
    ids = fx.sample_map.where(F.col("study_name") == "5-LOW").select("sample_id")
    assert "LeftSemi" in plan(Q.marker_presence_comparison(fx.staged("marker_presence"), ids))


def test_range_layout_splits_a_hot_sample(spark, tmp_dir):
    import glob
    import os

    from taxaspark.session import local_path
    hot = spark.range(200_000).select(F.lit("hot").alias("sample_id"),
                                      F.col("id").cast("string").alias("marker_id"))
    cold = spark.range(1000).select(F.concat(F.lit("s"), F.col("id")).alias("sample_id"),
                                    F.col("id").cast("string").alias("marker_id"))
    p = f"{tmp_dir}/t"
    write_table(hot.unionByName(cold), p, layout="range", partitions=8)
    files = [f for f in glob.glob(os.path.join(local_path(folder(spark, p)), "part-*.parquet"))]
    back = open_table(spark, p)
    assert back.count() == 201_000
    hot_files = back.where(F.col("sample_id") == "hot").select(F.input_file_name()).distinct().count()
    assert len(files) >= 4 and hot_files >= 4


def test_bloom_filter_written_for_high_cardinality_keys(spark, tmp_dir):
    import glob
    import os

    from taxaspark.session import local_path
    df = spark.range(500_000).select(F.md5(F.col("id").cast("string")).alias("sample_id")).coalesce(1)

    def size(p):
        return sum(os.path.getsize(f) for f in glob.glob(os.path.join(local_path(folder(spark, p)), "*.parquet")))
    write_table(df, f"{tmp_dir}/a", bloom=True)
    write_table(df, f"{tmp_dir}/b", bloom=False)
    assert size(f"{tmp_dir}/a") > size(f"{tmp_dir}/b")


def test_first_n_ids_are_pushed_as_in(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    p = f"{tmp_dir}/rel"
    write_table(fx.rel_ab, p)
    text = plan(Q.kingdom_composition_long(open_table(spark, p), 5))
    assert "In(sample_id," in text


def test_range_layout_splits_identical_copies(spark, tmp_dir):
    copies = spark.range(0, 200_000, 1, 8).select(F.lit("hot").alias("sample_id"), F.lit("m").alias("marker_id"))
    p = f"{tmp_dir}/copies"
    write_table(copies, p, layout="range", partitions=8)
    back = open_table(spark, p)
    assert back.count() == 200_000
    assert back.select(F.input_file_name()).distinct().count() >= 4


def test_point_lookup_opens_two_files_at_most(spark, tmp_dir):
    """The default layout clusters the whole table: a sample lies in one or two of many files."""
    fx = Fixtures(spark, SF_SMALL)
    p = f"{tmp_dir}/t"
    write_table(fx.staged("marker_abundance"), p, partitions=12)
    back = open_table(spark, p).select("sample_id", F.input_file_name().alias("file"))
    assert back.select("file").distinct().count() >= 10
    assert back.distinct().groupBy("sample_id").count().agg(F.max("count")).first()[0] <= 2


def test_partitions_follow_the_input(spark, tmp_dir):
    from taxaspark.operators.staging import partitions_for
    spark.range(2_000_000).select(F.md5(F.col("id").cast("string")).alias("sample_id")).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    assert partitions_for(df, 1 << 20) > 40 and partitions_for(df, 1 << 40) <= spark.sparkContext.defaultParallelism
    assert partitions_for(df.limit(1)) >= 1


def test_a_joins_partitions_follow_the_sum_of_its_inputs(spark, tmp_dir):
    """The planner's estimate of a join is the product of both sides."""
    from taxaspark.operators.staging import partitions_for
    ids = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("sample_id"))
    for name in ("a", "b"):
        ids.write.parquet(f"{tmp_dir}/{name}")
    a, b = (spark.read.parquet(f"{tmp_dir}/{name}") for name in ("a", "b"))
    few = partitions_for(a, 1 << 20)
    assert few <= partitions_for(a.join(b, "id").drop(b.sample_id), 1 << 20) <= 2 * few + 1
    assert partitions_for(a.select("id"), 1 << 20) == few  # columns that are left out don't shrink the rows made from the rest


def test_more_ids_than_a_literal_list(spark):
    fx = Fixtures(spark, SF_SMALL)
    q = Q.kingdom_composition_long(fx.rel_ab, Q.MAX_ID_LIST + 1)
    assert "LeftSemi" in plan(q)
    assert q.count() == Q.kingdom_rows(fx.rel_ab).count()


def test_long_id_list_becomes_semi_join(spark):
    fx = Fixtures(spark, SF_SMALL)
    ab = fx.staged("marker_abundance")
    ids = [r[0] for r in ab.select("sample_id").distinct().limit(3).collect()]
    many = ids + [f"x{i}" for i in range(Q.MAX_ID_LIST + 5)]
    a = Q.restrict_samples(ab, ids)
    b = Q.restrict_samples(ab, many)
    assert "LeftSemi" in plan(b) and "LeftSemi" not in plan(a)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_approximate_top_markers_is_one_level(spark):
    fx = Fixtures(spark, SF_SMALL)
    ab = fx.staged("marker_abundance")
    exact = Q.top_markers_by_mean(ab, k=50)
    approx = Q.top_markers_by_mean(ab, k=50, approx_rsd=0.02)
    assert plan(exact, "simple").count("Exchange hashpartitioning") == 2
    assert plan(approx, "simple").count("Exchange hashpartitioning") == 1
    e = {r.marker_id: r.sample_count for r in exact.collect()}
    a = {r.marker_id: r.sample_count for r in approx.collect()}
    assert set(e) == set(a)  # ranking is on the exact mean either way
    assert all(abs(a[m] - e[m]) <= max(1, 0.1 * e[m]) for m in e)
