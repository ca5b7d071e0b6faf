"""Exports: staged tables joined with the sample map, globally sorted, zstd Parquet; CSV."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from taxaspark.operators.joins import join_sample_map
from taxaspark.operators.staging import partitions_for, range_sorted
from taxaspark.plans.queries import restrict_samples
from taxaspark.schemas import DATASETS, Dataset
from taxaspark.sources.snapshots import Manifest, publish

# The third sort key of each dataset's export.
EXPORT_SORT_KEY = {
    "marker_abundance": "marker_id",
    "marker_presence": "marker_id",
    "marker_rel_ab_w_read_stats": "clade_name",
    "metaphlan_viruses_list": "mv_group_cluster",
}

#: Rows that one task sorts, about: bytes of files say little of them where files are compressed well.
TASK_ROWS = 1 << 20
SHUFFLE_KEY = "spark.sql.shuffle.partitions"


@contextmanager
def least_shuffle_partitions(spark: SparkSession, least: int):
    """Joins that run in here are dealt to ``least`` tasks or more (AQE puts small ones together); the setting is put back."""
    kept = spark.conf.get(SHUFFLE_KEY)
    spark.conf.set(SHUFFLE_KEY, str(max(int(kept), least)))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_KEY, kept)


def export_frame(stg: DataFrame, sample_map: DataFrame, ds: Dataset | str, partitions: int | None = None) -> DataFrame:
    """Staged columns plus ``study_name`` and ``sample_name``, sorted for export.

    Sorted on (study, sample name, dataset key).  ``sample_id`` and a row hash only
    shape the ranges, so that a large study or a large group of copies is cut into several.
    """
    ds = DATASETS[ds] if isinstance(ds, str) else ds
    cols = ["sample_id", *[f.name for f in ds.raw_schema.fields]]
    data = stg.select(*cols)
    joined = join_sample_map(data, sample_map, ["study_name", "sample_name"]).select(*cols, "study_name", "sample_name")
    return range_sorted(joined, export_keys(ds), ["sample_id"],
                        partitions or partitions_for(data))


def export_keys(ds: Dataset | str) -> list[str]:
    """Sort keys of a dataset's export."""
    return ["study_name", "sample_name", EXPORT_SORT_KEY[ds if isinstance(ds, str) else ds.name]]


def _refuse_overlap(made: Manifest) -> None:
    if not made.ordered():
        raise ValueError(f"files of the export overlap in {made.keys}")


def export_parquet(df: DataFrame, path: str, compression: str = "zstd",
                   max_records_per_file: int | None = None, keys: list[str] | None = None) -> Manifest:
    """Publish ``df`` at ``path`` as Parquet part files whose order follows the sort; a failure leaves the old export.

    Given the sort ``keys``, the manifest lists each file's first and last key, and files whose
    ranges overlap refuse the export.
    """
    w = df.write.option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return publish(df.sparkSession, path, w.parquet, keys or [], accept=_refuse_overlap if keys else None)[0]


def export_dataset(stg: DataFrame, sample_map: DataFrame, ds: Dataset | str, path: str) -> Manifest:
    """Publish ``export_frame`` at ``path``; its tasks grow with the staged rows, which are counted first (columns aren't read for it)."""
    parts = max(partitions_for(stg), -(-stg.count() // TASK_ROWS))
    with least_shuffle_partitions(stg.sparkSession, parts):
        return export_parquet(export_frame(stg, sample_map, ds, parts), path, keys=export_keys(ds))


def export_csv(df: DataFrame, path: str, sample_ids: Iterable[str] | None = None,
               header: bool = True) -> Manifest:
    """Publish standard CSV (quotes doubled) with a header line at ``path``; optionally only some samples.

    NULL is an empty field, an empty string is ``""``.  A failure leaves the old export.
    """
    if sample_ids is not None:
        df = restrict_samples(df, sample_ids)
    return publish(df.sparkSession, path, df.write.option("header", header).option("escape", '"').csv)[0]
