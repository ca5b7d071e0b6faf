"""Small tables derived from a staged table and published with it.

A companion lies in the published folder of its table under a name that readers of the table skip
(``_<name>``), is made from the files just written, and changes in the same step.  Kinds:

- ``names_<column>``: the distinct values of a column and their rows.  LIKE is resolved
  there and reaches the table's scan as ``IN``, so Parquet dictionaries skip row groups.
- ``sketches``: mergeable HLL sketches of columns for each of ``PARTS`` groups of samples; an estimate
  reads these alone, and those of several tables (or batches) are united.
- ``sample_codes`` and ``bitmaps_<column>``: a number for each sample, and for each value the bitmap
  of the samples that have it; distinct counts are sums of bit counts, and bitmaps of several tables with the same codes are united by OR.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.operators.joins import semi_join_keys
from taxaspark.schemas import Dataset
from taxaspark.sources.snapshots import folder

PARTS = 64
#: Precision of the sketches: a relative standard error of about 0.8 %.
LOG_SIZE = 14
#: The most names that are pushed to the scan as a list.
MAX_NAMES = 10_000

Maker = Callable[[DataFrame], DataFrame]


def open_companion(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The companion ``name`` of the table published at ``path``."""
    return spark.read.parquet(f"{folder(spark, path)}/_{name}")


# Names ---------------------------------------------------------------------

def names(column: str) -> Maker:
    return lambda df: df.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("num_rows"))


def with_names(df: DataFrame, column: str, chosen: DataFrame, limit: int = MAX_NAMES) -> DataFrame:
    """Rows of ``df`` whose ``column`` is one of ``chosen`` (a ``name`` column, from a names table).

    Up to ``limit`` names are pushed to the scan as a list; more are semi joined, with the same result.
    """
    found = [r["name"] for r in chosen.select("name").where("name is not null").limit(limit + 1).collect()]
    if len(found) <= limit:
        return df.where(F.col(column).isin(found))
    return semi_join_keys(df, chosen.select(F.col("name").alias(column)), column).select(*df.columns)


# Sketches ------------------------------------------------------------------

def sketches(columns: list[str], key: str = "sample_id") -> Maker:
    return lambda df: df.groupBy(F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int").alias("part")).agg(
        *[F.hll_sketch_agg(c, LOG_SIZE).alias(c) for c in columns])


def estimated_distinct(tables: list[DataFrame], column: str, name: str) -> DataFrame:
    """One row: the distinct values of ``column`` over all the tables that these sketches come from."""
    every = tables[0].select(column)
    for t in tables[1:]:
        every = every.unionByName(t.select(column))
    return every.agg(F.hll_sketch_estimate(F.hll_union_agg(column)).alias(name))


# Bitmaps -------------------------------------------------------------------

def sample_codes(df: DataFrame) -> DataFrame:
    """(sample_id, code): codes rise without gaps inside a task's range, so bitmaps of samples are dense."""
    ids = df.where("sample_id is not null").select("sample_id").distinct().repartitionByRange("sample_id").sortWithinPartitions("sample_id")
    return ids.withColumn("code", F.monotonically_increasing_id() + 1)


def bitmaps(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """(column, bucket, bitmap): the samples that have each value, 32,768 codes a bitmap.

    One aggregation whose state is the bitmap itself.  Rows are dealt by value and bucket first: as rows
    they are some dozens of bytes, while a bitmap for each value, bucket and task is 4 KB, whatever it holds.
    A value of very many rows is spread over its buckets.
    """
    rows = df.select(column, "sample_id").join(codes, "sample_id")
    places = rows.select(column, F.bitmap_bucket_number("code").alias("bucket"), F.bitmap_bit_position("code").alias("position"))
    return places.repartition(column, "bucket").groupBy(column, "bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))


def united(tables: list[DataFrame], column: str) -> DataFrame:
    """Bitmaps of several tables with the same codes, united."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy(column, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def sample_counts(maps: DataFrame, column: str, name: str = "sample_count") -> DataFrame:
    """(column, name): exact distinct samples of each value, from its bitmaps."""
    return maps.groupBy(column).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def for_dataset(ds: Dataset) -> dict[str, Maker]:
    """The companions of a dataset's staged table that the queries use."""
    fields = [f.name for f in ds.raw_schema.fields]
    out: dict[str, Maker] = {"sketches": sketches(["sample_id", fields[0]])}
    if "clade_name" in fields:
        out["names_clade_name"] = names("clade_name")
    return out
