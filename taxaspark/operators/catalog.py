"""Catalog profile of the layers: schemas, row counts, sizes and a summary.

Row counts are Spark aggregates over each table; byte sizes are the summed
lengths of the table's files, read through the ``binaryFile`` source with only
``length`` selected (file contents are not read).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.sources.raw import few_listing_tasks, folder_groups, folder_paths, many_files_a_task, one_by_one
from taxaspark.sources.snapshots import folder, publish

TABLE, VIEW, EXTERNAL = "TABLE", "VIEW", "EXTERNAL"

# Warehouse names of the column types in use.
TYPE_NAMES = {
    T.StringType: "STRING",
    T.DoubleType: "FLOAT",
    T.FloatType: "FLOAT",
    T.LongType: "INTEGER",
    T.IntegerType: "INTEGER",
    T.ShortType: "INTEGER",
    T.ByteType: "INTEGER",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "DATETIME",
    T.DateType: "DATE",
    T.BinaryType: "BYTES",
}


def type_name(dt: T.DataType) -> str:
    for cls, name in TYPE_NAMES.items():
        if isinstance(dt, cls):
            return name
    if isinstance(dt, T.DecimalType):
        return "NUMERIC"
    return dt.simpleString().upper()


@dataclass
class TableEntry:
    """One catalog object.  ``df`` is its DataFrame, or opens it when called; its files lie below ``path``.

    ``files_glob`` (a file-name pattern) and ``files_regex`` (on the full path)
    pick the table's files there; tables default to ``*.parquet``.  Where opening ``df`` takes a listing of very many files,
    ``like`` opens something with the same fields, and ``count`` its rows.
    """
    table_id: str
    table_type: str
    df: DataFrame | Callable[[], DataFrame]
    path: str | None = None
    clustering_fields: list[str] = field(default_factory=list)
    view_query: str | None = None
    external_config: dict | None = None
    files_glob: str | None = None
    files_regex: str | None = None
    like: Callable[[], DataFrame] | None = None
    count: Callable[[], int] | None = None

    def fields(self) -> list[T.StructField]:
        return (self.like() if self.like else self.open()).schema.fields

    def open(self) -> DataFrame:
        """Opened once: profile and schema then list its files once."""
        if callable(self.df):
            self.df = self.df()
        return self.df


CATALOG_SCHEMA = T.StructType([
    T.StructField("table_id", T.StringType(), False),
    T.StructField("position", T.IntegerType(), False),
    T.StructField("field_name", T.StringType(), False),
    T.StructField("field_type", T.StringType(), False),
    T.StructField("mode", T.StringType(), False),
])


def schema_catalog(spark: SparkSession, entries: list[TableEntry]) -> DataFrame:
    """One row per table × field: name, warehouse type and mode.

    A table that can't be opened has no rows here; its error is in the profile.
    """
    rows = []
    for e in entries:
        try:
            fields = e.fields()
        except Exception:
            continue
        rows += [(e.table_id, i, f.name, type_name(f.dataType), "NULLABLE" if f.nullable else "REQUIRED")
                 for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def files_bytes(spark: SparkSession, path: str, glob: str | None = None, regex: str | None = None) -> int:
    """Total bytes of the files below ``path`` whose name matches ``glob`` and path ``regex``.

    Listed recursively by Spark's (distributed) file listing, a group of folders after the other where there are very
    many; only ``path`` and ``length`` are selected, so file contents are never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    total = 0
    for folders in one_by_one(folder_groups(spark, path)):
        with few_listing_tasks(spark):
            files = reader.load(path if folders is None else folder_paths(path, folders)).select("path", "length")
        if regex:  # matched against the decoded path (file paths are URIs)
            files = files.where(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))).rlike(regex))
        with many_files_a_task(spark):
            total += files.agg(F.sum("length").alias("b")).first()["b"] or 0
    return int(total)


PROFILE_SCHEMA = T.StructType([
    T.StructField("table_id", T.StringType(), False),
    T.StructField("table_type", T.StringType(), True),
    T.StructField("num_fields", T.IntegerType(), True),
    T.StructField("num_rows", T.LongType(), True),
    T.StructField("num_bytes", T.LongType(), True),
    T.StructField("size_gb", T.DoubleType(), True),
    T.StructField("clustering_fields", T.ArrayType(T.StringType()), True),
    T.StructField("view_query", T.StringType(), True),
    T.StructField("external_config", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
])


def table_profile(spark: SparkSession, entries: list[TableEntry], count_external: bool = False) -> DataFrame:
    """Per table: type, field count, rows, bytes, GB, clustering, view query, scan config.

    Views get NULL sizes.  External tables get their file bytes from the
    listing; their row count (a full scan of the raw files) is NULL unless
    ``count_external`` is set.  Table row counts come from Parquet footers.
    A table whose profile fails gets an ``error`` and the run goes on.
    """
    rows = []
    for e in sorted(entries, key=lambda x: x.table_id):
        try:
            num_fields = len(e.fields())
            num_rows = num_bytes = size_gb = None
            if e.table_type == TABLE or (e.table_type == EXTERNAL and count_external):
                num_rows = e.count() if e.count else e.open().count()
            if e.table_type in (TABLE, EXTERNAL):
                if e.path:
                    glob = e.files_glob or ("*.parquet" if e.table_type == TABLE else None)
                    path = folder(spark, e.path) if e.table_type == TABLE else e.path
                    num_bytes = files_bytes(spark, path, glob, e.files_regex)
                size_gb = round(num_bytes / 1024 ** 3, 2) if num_bytes else 0.0
            rows.append((e.table_id, e.table_type, num_fields, num_rows, num_bytes, size_gb,
                         list(e.clustering_fields), e.view_query,
                         json.dumps(e.external_config, sort_keys=True) if e.external_config else None, None))
        except Exception as exc:  # the profile of the other tables goes on
            rows.append((e.table_id, None, None, None, None, None, None, None, None,
                         f"{type(exc).__name__}: {exc}"))
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def catalog_summary(profile: DataFrame) -> DataFrame:
    """One row: totals, counts by type and by name prefix, total rows and GB.

    Errored tables count in ``total_tables`` only.  The prefix is the text
    before the first '_' plus '_'; the GB total is the sum of per-table rounded
    GBs, rounded again.  Tables are counted by (type, prefix) first, so the maps are
    built from those few groups.
    """
    ok = F.col("error").isNull()
    prefix = F.when(ok, F.concat(F.split(F.col("table_id"), "_").getItem(0), F.lit("_")))
    groups = profile.groupBy(F.when(ok, F.col("table_type")).alias("kind"), prefix.alias("prefix")).agg(
        F.count(F.lit(1)).alias("tables"), F.sum(F.when(ok, F.col("num_rows"))).alias("num_rows"),
        F.sum(F.when(ok, F.col("size_gb"))).alias("size_gb"))
    one = groups.agg(
        F.coalesce(F.sum("tables"), F.lit(0)).cast("bigint").alias("total_tables"),
        F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("kind", "prefix", "tables"))).alias("groups"),
        F.coalesce(F.sum("num_rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.round(F.coalesce(F.sum("size_gb"), F.lit(0.0)), 2).alias("total_size_gb"))

    def counts(key: str):
        keys = F.array_sort(F.array_distinct(F.transform("groups", lambda g: g[key])))
        of = lambda k: F.filter("groups", lambda g: g[key] == k)
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.aggregate(of(k), F.lit(0).cast("bigint"), lambda n, g: n + g["tables"])))

    return one.select("total_tables", counts("kind").alias("by_type"), counts("prefix").alias("by_prefix"),
                      "total_rows", "total_size_gb")


def table_listing(profile: DataFrame) -> DataFrame:
    """All tables with type, rows and size, by name."""
    return profile.select("table_id", "table_type", "num_rows", "size_gb", "error").orderBy("table_id")


def write_catalog_json(profile: DataFrame, summary: DataFrame, schema: DataFrame, path: str) -> None:
    """Publish the profile, schema catalog and summary at ``path`` as JSON lines, in a folder each.

    All three change at once; a failure leaves the old ones (see ``sources.snapshots``).
    """
    def write(to: str) -> None:
        profile.write.json(f"{to}/tables")
        schema.write.json(f"{to}/schema")
        summary.write.json(f"{to}/summary")

    publish(profile.sparkSession, path, write)
