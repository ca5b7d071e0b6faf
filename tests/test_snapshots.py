"""Published folders: readers never miss a table, failures leave the old one, old folders expire."""

import os
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from taxaspark.operators.staging import write_table
from taxaspark.plans.exports import export_csv, export_parquet
from taxaspark.session import local_path
from taxaspark.sources import snapshots as S
from taxaspark.sources.tables import open_table, replace_table


def folders(spark, path):
    return sorted(os.listdir(os.path.join(local_path(path), "data")))


def test_a_reader_never_misses_the_table(spark, tmp_dir):
    """Twenty refreshes under a reader that looks all the time; each read sees one whole version."""
    path, seen, stop, faults = f"{tmp_dir}/t", set(), threading.Event(), []
    write = lambda n: spark.range(n * 1000).select(F.lit(n).alias("version"), "id").write.parquet
    replace_table(spark, path, write(1))

    def read():
        while not stop.is_set():
            try:
                rows = open_table(spark, path).groupBy("version").count().collect()
                assert len(rows) == 1 and rows[0]["count"] == rows[0]["version"] * 1000
                seen.add(rows[0]["version"])
            except Exception as exc:
                faults.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 22):
        replace_table(spark, path, write(n))
    stop.set()
    reader.join()
    assert not faults and len(seen) > 2
    assert open_table(spark, path).count() == 21_000
    assert len(folders(spark, path)) == S.KEEP


def test_two_refreshes_at_once_leave_one_whole_winner(spark, tmp_dir):
    path, made = f"{tmp_dir}/t", []
    jobs = [threading.Thread(target=lambda n=n: made.append((S.publish(spark, path, spark.range(n).write.parquet, [])[0].number, n)))
            for n in range(100, 108)]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    assert sorted(number for number, _ in made) == list(range(1, 9))
    assert open_table(spark, path).count() == max(made)[1]


def test_a_failure_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert replace_table(spark, path, spark.range(1).write.parquet, lambda df: df.count()) == 1
    before = folders(spark, path)
    with pytest.raises(ZeroDivisionError):
        replace_table(spark, path, spark.range(2).write.parquet, lambda df: 1 // 0)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_table(spark, path, broken.write.parquet)
    assert open_table(spark, path).count() == 1 and folders(spark, path) == before


def test_orphans_go_and_plain_folders_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert S.latest(spark, path) is None and S.folder(spark, path) == path
    spark.range(3).write.parquet(path)
    assert open_table(spark, path).count() == 3
    replace_table(spark, path, spark.range(4).write.parquet)  # published over the plain folder
    assert open_table(spark, path).count() == 4
    os.makedirs(f"{local_path(path)}/data/died")
    S.expire(spark, path)
    assert len(folders(spark, path)) == 2
    S.expire(spark, path, orphan_hours=-1)
    assert len(folders(spark, path)) == 1 and open_table(spark, path).count() == 4


def test_a_manifest_is_created_once(spark, tmp_dir):
    files = S.FileAccess(spark, tmp_dir)
    assert files.create_new(f"{tmp_dir}/m/1.json", "{}") and not files.create_new(f"{tmp_dir}/m/1.json", "[]")
    assert files.read(f"{tmp_dir}/m/1.json") == "{}" and files.read(f"{tmp_dir}/m/2.json") is None
    assert files.names(f"{tmp_dir}/none") == []


def test_manifest_lists_key_ranges(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.range(10_000).select(F.format_string("%05d", "id").alias("sample_id"))
    write_table(df, path, partitions=4)
    made = S.latest(spark, path)
    assert made.rows == 10_000 and made.ordered() and len(made.files) == 4
    assert made.files[0]["first"] == ["00000"] and made.files[-1]["last"] == ["09999"]
    mixed = export_parquet(df.repartition(4), f"{tmp_dir}/x")
    assert mixed.rows == 10_000
    with pytest.raises(ValueError, match="overlap"):
        export_parquet(df.repartition(4), f"{tmp_dir}/x", keys=["sample_id"])
    assert S.latest(spark, f"{tmp_dir}/x").number == mixed.number
    nulls = S.Manifest("f", files=[{"first": [None], "last": ["a"]}, {"first": ["a"], "last": ["b"]}])
    assert nulls.ordered()
    nulls.files.reverse()
    assert not nulls.ordered()


def test_a_failed_csv_export_leaves_the_old(spark, tmp_dir):
    path = f"{tmp_dir}/c"
    export_csv(spark.range(5), path)
    with pytest.raises(Exception):
        export_csv(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert spark.read.option("header", True).csv(S.folder(spark, path)).count() == 5


RETRIES = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from taxaspark.operators.staging import write_table
from taxaspark.sources.snapshots import latest

spark = SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false").getOrCreate()

def fail_first(batches):
    from pyspark import TaskContext
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("sample_id"), "id")
for layout in ("range", "local"):
    write_table(rows.mapInArrow(fail_first, "sample_id string, id long"), sys.argv[2], layout=layout, partitions=5, count_rows=True)
    made = latest(spark, sys.argv[2])
    print("COUNTED", made.counts["rows"], made.counts["keyed"], made.rows)
"""


def test_rows_are_counted_once_whatever_fails(tmp_dir):
    """Every task's first attempt fails after its rows, and the range bounds are sampled from the same rows: counts hold all the same."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", RETRIES, root, f"{tmp_dir}/t"], capture_output=True, text=True, timeout=240)
    assert [x for x in out.stdout.splitlines() if x.startswith("COUNTED")] == ["COUNTED 3000 2000 2000"] * 2, out.stderr[-2000:]


def test_the_manifest_takes_each_files_ends_without_sorting_its_rows(spark, tmp_dir):
    """Nulls come first; the rows that Spark aggregates are those of batches, not of the table."""
    rows = [(None, "x"), ("b", None), ("b", "a"), ("", "z"), ("\u00e9", "m"), ("a", "q"), ("a", "b")]
    path = f"{tmp_dir}/t"
    for i, part in enumerate((rows, rows[1:3], rows[3:])):
        spark.createDataFrame(part, "k string, m string").coalesce(1).write.mode("append").parquet(path)
    df = spark.read.parquet(path)
    plan = S.file_ends(df, ["k", "m"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract" not in plan
    n, files = S.describe(df, ["k", "m"])
    assert n == 13
    place = lambda key: [(v is not None, (v or "").encode()) for v in key]
    want = sorted((len(p), list(min(p, key=place)), list(max(p, key=place))) for p in ([list(r) for r in rows], [list(r) for r in rows[1:3]]))
    assert sorted((f["rows"], f["first"], f["last"]) for f in files if f["rows"] != 4) == want
    assert [(f["first"], f["last"]) for f in files if f["rows"] == 4] == [(["", "z"], ["\u00e9", "m"])]
    assert S.describe(df, [])[0] == 13


def test_ends_of_one_key_are_taken_by_hash_without_python(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    parts = ([("b",), (None,), ("é",), ("",)], [(None,), (None,)], [("a",)])
    for part in parts:
        spark.createDataFrame(part, "k string").coalesce(1).write.mode("append").parquet(path)
    df = spark.read.parquet(path)
    plan = S.file_ends(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan and "MapInArrow" not in plan
    n, files = S.describe(df, ["k"])
    assert n == 7 and sorted((f["rows"], f["first"], f["last"]) for f in files) == [(1, ["a"], ["a"]), (2, [None], [None]), (4, [None], ["é"])]
