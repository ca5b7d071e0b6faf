"""Staging: typed, key-filtered tables clustered by ``sample_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions.columns import lenient_double, lenient_long, null_sentinel
from taxaspark.schemas import DOUBLE, DOUBLE_DASH, KEEP, LONG, Dataset
from taxaspark.sources.tables import replace_table

LAYOUTS = ("range", "local")
#: Bytes of input (compressed files: some ten times that as rows) that one output partition should hold.
#: Smaller inputs are cut into a few parts all the same, of at least so many bytes, so that one task needn't do it all.
TARGET_BYTES = 16 * 1024 * 1024
FEW_PARTS, LEAST_BYTES = 8, 16 * 1024


def staged_columns(src: DataFrame, ds: Dataset) -> list:
    types = {f.name: f.dataType for f in src.schema.fields}
    cols = [F.col("sample_id")]
    for f in ds.raw_schema.fields:
        kind = ds.casts.get(f.name, KEEP)
        src_type = types[f.name]
        if kind == DOUBLE:
            c = lenient_double(f.name, src_type)
        elif kind == DOUBLE_DASH:
            c = lenient_double(null_sentinel(f.name), src_type)
        elif kind == LONG:
            c = lenient_long(f.name, src_type)
        else:
            c = F.col(f.name)
        cols.append(c.alias(f.name))
    return cols


def stage(src: DataFrame, ds: Dataset) -> DataFrame:
    """``src_*`` → ``stg_*``: lenient casts, rows without a sample id dropped."""
    return src.where(F.col("sample_id").isNotNull()).select(*staged_columns(src, ds))


def staged_rows(src: DataFrame, ds: Dataset) -> DataFrame:
    """``stage`` before rows without a sample id are dropped."""
    return src.select(*staged_columns(src, ds))


def planned_bytes(df: DataFrame) -> int | None:
    """Bytes of all inputs that ``df`` reads, as the planner knows them; None where it can't be asked.

    The inputs' sum, not the plan's own estimate: that of a join is the product of its sides.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except AttributeError:  # a Spark Connect client has no plan to ask
        return None


def partitions_for(df: DataFrame, target: int = TARGET_BYTES) -> int:
    """Output partitions from input bytes: ``target`` each, and a few for small inputs.

    Without an estimate, the session's shuffle partitions.
    """
    return partitions_of(df.sparkSession, planned_bytes(df), target)


def partitions_of(spark: SparkSession, size: int | None, target: int = TARGET_BYTES) -> int:
    """``partitions_for`` inputs of ``size`` bytes in all."""
    if size is None or size >= 1 << 60:  # of some sources the planner knows no size and says the largest number
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    return max(min(cores, FEW_PARTS, 1 + size // LEAST_BYTES), -(-size // target), 1)


def range_sorted(df: DataFrame, keys: list[str], tie: list[str], partitions: int) -> DataFrame:
    """Globally sorted on ``keys``: one range exchange, then a sort of each range.

    ``tie``, a row hash and the task a row comes from follow the keys in the
    range bounds only, so a key with a large share of the rows, even one of identical copies,
    is cut into several ranges.  A row's task is the same when a task is retried.
    """
    spread = "__task"
    marked = df.withColumn(spread, F.spark_partition_id())
    bounds = [*keys, *tie, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), spread]
    return marked.repartitionByRange(partitions, *bounds).sortWithinPartitions(*keys).drop(spread)


def cluster(df: DataFrame, layout: str = "range", partitions: int | None = None,
            key: str = "sample_id") -> DataFrame:
    """Order rows for clustered storage on ``key``.

    ``range`` (default): every output file covers one range of keys, so a
    lookup opens one or two files; costs a sampling pass and a shuffle.
    ``local``: sort inside each task only, no shuffle; files overlap.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "local":
        return df.sortWithinPartitions(key)
    return range_sorted(df, [key], [], partitions or partitions_for(df))


def write_clustered(df: DataFrame, to: str, layout: str = "range", partitions: int | None = None, key: str = "sample_id",
                    bloom: bool = True, compression: str | None = None, mode: str = "errorifexists",
                    counted: Observation | None = None) -> None:
    """Writes ``df`` clustered on ``key`` as plain Parquet files into the folder ``to``.

    ``bloom`` asks Parquet for a bloom filter on ``key``.  It is written for
    row groups whose keys outgrow the dictionary; fully dictionary-encoded
    row groups skip it, since dictionary filtering already prunes them exactly.

    With ``counted``, rows whose key is null are counted and then dropped: ``rows`` and ``keyed`` are taken in
    the tasks that write, behind the exchange.  A stage that writes counts each partition once,
    also if tasks fail, are repeated or run twice; the range bounds' sampling pass counts nothing.
    """
    df = cluster(df, layout, partitions, key)
    if counted is not None:
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"), F.count(key).alias("keyed")).where(F.col(key).isNotNull())
    writer = df.write.mode(mode)
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(to)


def write_table(df: DataFrame, path: str, layout: str = "range", partitions: int | None = None,
                key: str = "sample_id", bloom: bool = True, compression: str | None = None, count_rows: bool = False,
                companions: dict | None = None) -> None:
    """Full refresh of a clustered Parquet table; readers see the old table until the new one is whole.

    ``count_rows`` drops rows whose key is null and keeps in the manifest how many rows came
    in (``rows``) and how many had a key (``keyed``); see ``write_clustered``.  ``companions`` are small
    tables published with it (``operators.companions``).
    """
    counted = Observation() if count_rows else None
    replace_table(df.sparkSession, path, lambda to: write_clustered(df, to, layout, partitions, key, bloom, compression, counted=counted),
                  keys=[key], counts=(lambda: dict(counted.get)) if counted else None, companions=companions)
