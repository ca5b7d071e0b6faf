"""Companion tables and block samples: the same answers with less read."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from bench_views.frames import Fixtures
from taxaspark import schemas
from taxaspark.operators import companions as C
from taxaspark.operators.sampling import sample_blocks
from taxaspark.operators.staging import write_table
from taxaspark.plans import queries as Q
from taxaspark.session import local_path
from taxaspark.sources.snapshots import folder
from taxaspark.sources.tables import open_table
from testdata_paths import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rel(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rel"))
    ds = schemas.DATASETS["marker_rel_ab_w_read_stats"]
    write_table(Fixtures(spark, SF_SMALL).staged(ds.name), path, companions=C.for_dataset(ds))
    return path


def test_readers_of_the_table_skip_companions(spark, rel):
    assert open_table(spark, rel).count() == Fixtures(spark, SF_SMALL).rel_ab.count()
    assert sorted(n for n in os.listdir(folder(spark, rel)) if n.startswith("_n") or n.startswith("_s")) == ["_names_clade_name", "_sketches"]


def test_like_through_names(spark, rel):
    table, names = open_table(spark, rel), C.open_companion(spark, rel, "names_clade_name")
    assert names.agg(F.sum("num_rows")).first()[0] == table.count()
    for like in ("%widget%", "k__%", "%no such taxon%"):
        fast, slow = Q.samples_with_taxon(table, like, 10.0, names=names), Q.samples_with_taxon(table, like, 10.0)
        assert fast.collect() == slow.collect()
    assert Q.kingdom_composition_long(table, 5, names=names).collect() == Q.kingdom_composition_long(table, 5).collect()
    assert "In(clade_name" in plan(Q.kingdom_composition_long(table, 5, names=names)) and "StartsWith" not in plan(
        Q.kingdom_composition_long(table, 5, names=names))
    chosen = names.where(F.col("name").like("k__%"))
    few, many = C.with_names(table, "clade_name", chosen), C.with_names(table, "clade_name", chosen, limit=3)
    assert "LeftSemi" in plan(many) and sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))


def test_estimates_read_sketches_alone(spark, rel, tmp_dir):
    """Also after another batch: the sketches of both are united."""
    more = spark.range(5000).select(F.concat(F.lit("new"), "id").alias("sample_id"), F.lit("k__X").alias("clade_name"))
    write_table(more, f"{tmp_dir}/batch", companions={"sketches": C.sketches(["sample_id", "clade_name"])})
    kept = [C.open_companion(spark, p, "sketches") for p in (rel, f"{tmp_dir}/batch")]
    for tables, rows in ((kept[:1], open_table(spark, rel)), (kept, open_table(spark, rel).select("sample_id").union(more.select("sample_id")))):
        df = C.estimated_distinct(tables, "sample_id", "n")
        exact = rows.select("sample_id").distinct().count()
        assert abs(df.first().n - exact) <= 0.03 * exact
        assert "relative_abundance" not in plan(df) and plan(df).count("_sketches") == len(tables)


def test_bitmaps_count_exactly(spark, tmp_dir):
    """A marker that a third of all rows have, repeated rows, one marker in one sample; bitmaps of two parts united."""
    rows = spark.range(30_000).select(F.concat(F.lit("s"), F.col("id") % 7000).alias("sample_id"),
                                      F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 500)).alias("marker_id"))
    rows = rows.union(spark.createDataFrame([("s1", "alone"), ("s1", "alone")], rows.schema))
    write_table(rows, f"{tmp_dir}/t", companions={"sample_codes": C.sample_codes})
    codes = C.open_companion(spark, f"{tmp_dir}/t", "sample_codes")
    want = {r.marker_id: r.n for r in rows.groupBy("marker_id").agg(F.count_distinct("sample_id").alias("n")).collect()}
    maps = C.bitmaps(rows, codes, "marker_id")
    assert {r.marker_id: r.n for r in C.sample_counts(maps, "marker_id", "n").collect()} == want
    halves = [C.bitmaps(rows.where(F.xxhash64("sample_id", "marker_id") % 2 == k), codes, "marker_id") for k in (0, 1, -1)]
    assert {r.marker_id: r.n for r in C.sample_counts(C.united(halves, "marker_id"), "marker_id", "n").collect()} == want
    # Few buckets: codes are dense inside a range.
    assert maps.select("bucket").distinct().count() <= 2 * spark.sparkContext.defaultParallelism


def test_no_bitmap_is_shuffled(spark, tmp_dir):
    """Bitmaps of few samples each are 4 KB apiece: rows go over the network, bitmaps stay in the task that counts them."""
    rows = spark.range(20_000).select(F.concat(F.lit("s"), F.col("id")).alias("sample_id"), F.concat(F.lit("m"), F.col("id") % 9000).alias("marker_id"))
    write_table(rows, f"{tmp_dir}/t", companions={"sample_codes": C.sample_codes})
    maps = C.bitmaps(open_table(spark, f"{tmp_dir}/t"), C.open_companion(spark, f"{tmp_dir}/t", "sample_codes"), "marker_id")
    counts = C.sample_counts(maps, "marker_id", "n")
    assert counts.agg(F.sum("n"), F.count("*")).first()[:] == (20_000, 9000)
    shuffled = [x for x in plan(counts).splitlines() if "Exchange hashpartitioning" in x]
    steps = plan(counts).split("Exchange hashpartitioning")
    assert shuffled and not any("bitmap_construct_agg" in below.split("\n", 2)[1] for below in steps[1:])


def test_a_block_sample_opens_its_files_only(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_table(spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("sample_id")), path, partitions=40)
    table = open_table(spark, path)
    taken = {r.f for r in sample_blocks(table, 30.0).select(F.input_file_name().alias("f")).distinct().collect()}
    files = glob.glob(f"{local_path(folder(spark, path))}/*.parquet")
    assert 3 <= len(taken) <= 22 and len(files) == 40
    n = sample_blocks(table, 30.0).count()
    assert 0 < n < 20_000 and sample_blocks(table, 100.0).count() == 20_000 and sample_blocks(table, 0.0).count() == 0
    keep = {os.path.basename(f) for f in taken}
    for f in files:  # all others are unreadable now
        if os.path.basename(f) not in keep:
            with open(f, "wb") as out:
                out.write(b"x" * 100)
    schema = table.schema
    again = spark.read.schema(schema).parquet(folder(spark, path))
    assert sample_blocks(again, 30.0).agg(F.count("sample_id")).first()[0] == n
