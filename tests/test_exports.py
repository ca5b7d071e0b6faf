"""Exports: zstd codec, global order across part files, row count = join count."""

import glob
import os

import pyarrow.parquet as pq

from taxaspark.operators.joins import join_sample_map
from taxaspark.plans.exports import export_csv, export_frame, export_parquet
from bench_views.frames import Fixtures
from taxaspark.session import local_path
from taxaspark.sources.snapshots import folder
from taxaspark.sources.tables import open_table
from testdata_paths import SF_MID


def test_export_is_zstd_sorted_and_complete(spark, tmp_dir):
    fx = Fixtures(spark, SF_MID)
    stg = fx.staged("marker_presence")
    out = f"{tmp_dir}/x"
    export_parquet(export_frame(stg, fx.sample_map, "marker_presence"), out)
    parts = sorted(glob.glob(os.path.join(local_path(folder(spark, out)), "part-*.parquet")))
    assert len(parts) > 1
    keys = []
    for p in parts:
        f = pq.ParquetFile(p)
        assert f.metadata.row_group(0).column(0).compression == "ZSTD"
        t = f.read(columns=["study_name", "sample_name", "marker_id"]).to_pylist()
        keys.extend((r["study_name"], r["sample_name"], r["marker_id"]) for r in t)
    assert keys == sorted(keys)
    joined = join_sample_map(stg, fx.sample_map, ["study_name", "sample_name"]).count()
    assert len(keys) == joined == open_table(spark, out).count()


def test_csv_export_has_header(spark, tmp_dir):
    fx = Fixtures(spark, SF_MID)
    stg = fx.staged("marker_abundance")
    sid = stg.first().sample_id
    out = f"{tmp_dir}/csv"
    export_csv(stg, out, sample_ids=[sid])
    files = glob.glob(os.path.join(local_path(folder(spark, out)), "part-*.csv"))
    first_lines = [open(f).readline().strip() for f in files if os.path.getsize(f)]
    assert first_lines and all(line == "sample_id,marker_id,abundance" for line in first_lines)
    back = spark.read.schema(stg.schema).option("header", True).csv(folder(spark, out))
    assert back.count() == stg.where(stg.sample_id == sid).count()


def test_csv_is_standard(spark, tmp_dir):
    """Read back by Python's csv module: quotes, separators, line ends, backslashes."""
    import csv
    import glob

    from taxaspark.plans.exports import export_csv
    rows = [("1", 'a "b", c'), ("2", "two\nlines"), ("3", "back\\slash, \\\"q"), ("4", ""), ("5", None)]
    export_csv(spark.createDataFrame(rows, "id string, text string").coalesce(1), f"{tmp_dir}/c")
    with open(glob.glob(f"{local_path(folder(spark, f'{tmp_dir}/c'))}/part-*")[0], newline="") as f:
        back = list(csv.reader(f))
    assert back == [["id", "text"], *[[i, t or ""] for i, t in rows]]


def test_tasks_of_an_export_grow_with_its_rows(spark, tmp_dir, monkeypatch):
    """A file that compresses well says little of its rows."""
    from taxaspark.plans import exports

    rows = spark.range(0, 5000, 1, 1).selectExpr("'s' as sample_id", "concat('m', id % 500) as marker_id", "1.0d as abundance")
    rows.write.parquet(f"{tmp_dir}/stg")
    samples = spark.createDataFrame([("s", "r", "n", "A")], "sample_id string, run_ids string, sample_name string, study_name string")
    monkeypatch.setattr(exports, "TASK_ROWS", 100, raising=False)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    made = exports.export_dataset(spark.read.parquet(f"{tmp_dir}/stg"), samples, "marker_abundance", f"{tmp_dir}/out")
    assert made.rows == 5000 and len(made.files) >= 25 and max(f["rows"] for f in made.files) <= 500
    assert spark.conf.get("spark.sql.shuffle.partitions") == kept
