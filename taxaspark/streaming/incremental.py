"""Incremental staging: the staging job of ``plans.jobs`` for newly arrived files.

The original pipeline only does full refreshes.  When new sample folders keep
arriving, the same scan → stage → clustered write can run as a Structured
Streaming query over the raw file glob: the file source remembers in its
checkpoint which files it has processed, ``availableNow`` processes every new
file and stops, and each micro-batch is written with ``overwrite`` into its
own ``batch=<id>`` folder, so a batch that is re-run after a failure replaces
its own output instead of duplicating it.  Read the table with
``spark.read.parquet(out).drop("batch")``.

The stream itself carries only names of files; each micro-batch reads its files as the batch job
does (``mode='auto'``), so a file may have any size.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.operators.staging import stage, write_clustered
from taxaspark.schemas import DEFAULT_RUN_TAG, Dataset
from taxaspark.sources.raw import dataset_glob, in_layout, scan_src


def raw_file_stream(spark: SparkSession, root: str, ds: Dataset, max_files_per_trigger: int | None = None,
                    paths: str | None = None, listing: str = "recursive") -> DataFrame:
    """Streaming DataFrame of the ``path`` of new raw files; no file is opened.

    ``recursive`` (default) lists ``root`` with Spark's listing and keeps the
    exact ``<root>/<one folder>/<tail>`` layout; ``glob`` expands the dataset
    glob on the driver at every trigger.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if paths is None and listing == "recursive":
        name = ds.path_tail.rsplit("/", 1)[-1]
        files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root).select("path")
        return files.where(in_layout(root, ds, "path"))
    return reader.load(paths or dataset_glob(root, ds)).select("path")


def stage_new_files(spark: SparkSession, root: str, ds: Dataset, out: str, checkpoint: str | None = None,
                    run_tag: str = DEFAULT_RUN_TAG, paths: str | None = None, id_pattern: str | None = None,
                    max_files_per_trigger: int | None = None, wait: bool = True, listing: str = "recursive", mode: str = "auto"):
    """Stage every raw file not seen before into ``out`` (one ``batch=<id>`` folder per micro-batch).

    ``checkpoint`` defaults to the folder ``<out>.checkpoint`` beside ``out``: the same at
    every call, so that processed files are not read again.  The names of a micro-batch's files go through the
    driver; ``max_files_per_trigger`` bounds them.
    """
    checkpoint = checkpoint or f"{out.rstrip('/')}.checkpoint"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Names are plain paths; what a path pattern would read into them is escaped.
        names = [re.sub(r"([\\\[\]{}*?])", r"\\\1", r["path"]) for r in batch.collect()]
        if names:
            src = scan_src(batch.sparkSession, root, ds, run_tag, paths=names, id_pattern=id_pattern, mode=mode)
            write_clustered(stage(src, ds), f"{out.rstrip('/')}/batch={batch_id:012d}", mode="overwrite")

    query = (raw_file_stream(spark, root, ds, max_files_per_trigger, paths, listing).writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    if wait:
        query.awaitTermination()
    return query
