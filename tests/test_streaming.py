"""Incremental staging picks up only new files and is exact."""

import gzip
import os

from taxaspark import schemas
from taxaspark.streaming import stage_new_files

AB = schemas.MARKER_ABUNDANCE


def put(root, sample, rows):
    p = os.path.join(root, schemas.DEFAULT_RUN_TAG, sample, AB.path_tail)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with gzip.open(p, "wt") as f:
        f.write("#a\n#b\n#c\n#d\n" + "".join(f"{m}\t{v}\n" for m, v in rows))


import pytest


@pytest.mark.parametrize("listing", ["recursive", "glob"])
def test_incremental_staging(spark, tmp_dir, listing):
    put(tmp_dir, "s1", [("m1", 1.0), ("m2", 2.0)])
    out, ckpt = f"{tmp_dir}/stg", f"{tmp_dir}/ckpt"
    stage_new_files(spark, f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", AB, out, ckpt, listing=listing)
    first = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch").collect())
    assert first == [("s1", "m1", 1.0), ("s1", "m2", 2.0)]
    put(tmp_dir, "s2", [("m1", 5.0)])
    stage_new_files(spark, f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", AB, out, ckpt, listing=listing)
    both = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch").collect())
    assert both == [("s1", "m1", 1.0), ("s1", "m2", 2.0), ("s2", "m1", 5.0)]
    # nothing new: nothing added
    stage_new_files(spark, f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", AB, out, ckpt, listing=listing)
    assert spark.read.parquet(out).count() == 3


def test_default_checkpoint_is_stable(spark, tmp_dir):
    for i in range(3):
        put(tmp_dir, f"s{i}", [("m1", 1.0)])
    root, out = f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", f"{tmp_dir}/stg"
    stage_new_files(spark, root, AB, out, max_files_per_trigger=1)
    stage_new_files(spark, root, AB, out)  # nothing new
    assert spark.read.parquet(out).count() == 3


def test_the_stream_carries_names_only(spark, tmp_dir):
    """Files of any size: each micro-batch reads its files as the batch job does, here line by line; odd names too."""
    for sample in ("s 1+x", "a[b]{c}", "s3"):
        put(tmp_dir, sample, [(f"m{i}", float(i)) for i in range(50)])
    root, out = f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", f"{tmp_dir}/stg"
    stage_new_files(spark, root, AB, out, mode="lines")
    got = spark.read.parquet(out).groupBy("sample_id").count().collect()
    assert {r["sample_id"]: r["count"] for r in got} == {"s 1+x": 50, "a[b]{c}": 50, "s3": 50}
