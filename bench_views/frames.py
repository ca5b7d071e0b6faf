"""Profile-shaped views over the driver's benchmark tables.

The benchmark tables (orders, lineitem, part, supplier, events) are recast as
the sample map, the five profile datasets (raw string form and staged form) and
the accession dump, so that every query in this package runs on data whose
size grows with the scale factor.  Each builder mirrors one view of
FIXTURES.md §2; ``bench_views.sql`` has the same views as SQL.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark import schemas
from taxaspark.operators.staging import planned_bytes, stage
from taxaspark.session import local_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _md5(c: str) -> Column:
    return F.md5(_s(c))


class Fixtures:
    """Lazily built fixture DataFrames over ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def sample_map(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            _md5("o_orderkey").alias("sample_id"),
            F.concat(F.lit("ERR"), _s(F.lit(1000000) + F.col("o_orderkey"))).alias("run_ids"),
            F.concat(F.lit("S"), _s("o_orderkey")).alias("sample_name"),
            F.col("o_orderpriority").alias("study_name"),
        )

    @cached_property
    def marker_abundance(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            _md5("l_orderkey").alias("sample_id"),
            F.concat(F.lit("M"), _s("l_partkey")).alias("marker_id"),
            F.col("l_quantity").alias("abundance"),
        )

    @cached_property
    def marker_presence(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            _md5("l_orderkey").alias("sample_id"),
            F.concat(F.lit("M"), _s("l_partkey")).alias("marker_id"),
            F.when(F.col("l_discount") > 0.05, 1).otherwise(0).cast("bigint").alias("presence"),
        )

    @cached_property
    def raw_rel_ab(self) -> DataFrame:
        li = self.table("lineitem")
        p = self.table("part")
        j = li.join(p, li["l_partkey"] == p["p_partkey"])
        ln = F.col("l_linenumber")
        qty = F.col("l_quantity").cast("bigint")
        return j.select(
            _md5("l_orderkey").alias("sample_id"),
            F.when(ln <= 2, F.concat(F.lit("k__"), F.col("p_type")))
             .when(ln <= 4, F.concat(F.lit("k__"), F.col("p_type"), F.lit("|p__"), F.col("p_brand")))
             .otherwise(F.concat(F.lit("k__"), F.col("p_type"), F.lit("|p__"), F.col("p_brand"),
                                 F.lit("|s__"), F.col("p_name"))).alias("clade_name"),
            _s("l_partkey").alias("clade_taxid"),
            F.when(ln == 7, F.lit("n/a")).otherwise(_s(qty)).alias("relative_abundance"),
            F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(_s(qty + ln)).alias("coverage"),
            _s(F.floor("l_extendedprice").cast("bigint")).alias("estimated_reads"),
        )

    @cached_property
    def raw_unknown(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(
            _md5("s_suppkey").alias("sample_id"),
            F.concat(F.lit("UNKNOWN_"), _s("s_nationkey")).alias("clade_name"),
            _s("s_nationkey").alias("ncbi_tax_id"),
            F.when(F.col("s_nationkey") == 3, F.lit("-"))
             .otherwise(_s(F.col("s_nationkey") * 4)).alias("relative_abundance"),
        )

    @cached_property
    def viruses(self) -> DataFrame:
        e = self.table("events")
        eid = F.col("event_id")
        return e.select(
            _md5("user_id").alias("sample_id"),
            F.concat(F.lit("vg"), _s(eid % 97)).alias("mv_group_cluster"),
            F.concat(F.lit("genome_"), _s(eid)).alias("genome_name"),
            (F.lit(1000) + eid % 50000).cast("bigint").alias("length"),
            (F.col("value") / 1000).alias("breadth_of_coverage"),
            (eid % 1000).cast("bigint").alias("mapping_reads_count"),
            F.col("value").alias("rpkm"),
            (F.col("value") / 10).alias("depth_of_coverage_mean"),
            (F.col("value") / 20).alias("depth_of_coverage_median"),
            F.when(eid % 3 == 0, F.lit("unknown")).otherwise(F.lit("known")).alias("mv_group_type"),
            F.col("event_type").alias("assigned_taxonomy"),
            F.concat(F.lit("g"), _s(eid % 13)).alias("first_genome_in_cluster"),
            F.col("props").alias("other_genomes_in_cluster"),
        )

    @cached_property
    def raw_accessions(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.concat(F.lit("ERR"), _s(F.lit(1000000) + F.col("o_orderkey"))).alias("Accession"),
            F.concat(F.lit("ERA"), _s("o_custkey")).alias("Submission"),
            F.when(F.col("o_orderstatus") == "P", F.lit("-")).otherwise(F.col("o_orderstatus")).alias("Status"),
            F.when(F.col("o_custkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit('the "C", '), _s("o_custkey"))).alias("Center"),
            _s("o_custkey").alias("Spots"),
        )

    # Rows by supplier: raw runs of a few hundred files that together hold every row.

    def by_supplier(self, name: str) -> DataFrame:
        """``sample_id`` (of a supplier) and the raw columns of a dataset made from lineitem, all rows."""
        li = self.table("lineitem").withColumn("l_orderkey", F.col("l_suppkey"))
        view = Fixtures(self.spark, self.sf_dir)
        view._tables = {"lineitem": li, "part": self.table("part")}
        return getattr(view, self.SOURCES[name])

    @cached_property
    def quoted_text(self) -> DataFrame:
        """Texts with quotes, separators, line ends, empty and NULL fields."""
        o = self.table("orders")
        k = F.col("o_orderkey") % 6
        text = (F.when(k == 0, F.concat(F.lit('a "b", c '), _s("o_orderkey"))).when(k == 1, F.lit("")).when(k == 2, F.lit(None))
                .when(k == 3, F.lit('""')).when(k == 4, F.lit("two\nlines, \\ back")).otherwise(F.lit("plain")))
        return o.select(_s("o_orderkey").alias("id"), text.alias("text"), F.col("o_orderpriority").alias("last"))

    @cached_property
    def odd_numbers(self) -> DataFrame:
        """Strings that casts of different engines disagree on, one for each lineitem row."""
        li = self.table("lineitem")
        pick = F.element_at(F.array(*[F.lit(v) for v in ODD_NUMBERS]), (F.col("l_partkey") % len(ODD_NUMBERS) + 1).cast("int"))
        return li.select("l_orderkey", "l_linenumber", pick.alias("text"))

    # Staged forms (the stg_* tables) -------------------------------------

    # Source view of each dataset (the src_* layer it is staged from).
    SOURCES = {
        "marker_abundance": "marker_abundance",
        "marker_presence": "marker_presence",
        "marker_rel_ab_w_read_stats": "raw_rel_ab",
        "metaphlan_unknown_list": "raw_unknown",
        "metaphlan_viruses_list": "viruses",
    }

    def staged(self, name: str) -> DataFrame:
        return stage(getattr(self, self.SOURCES[name]), schemas.DATASETS[name])

    @cached_property
    def rel_ab(self) -> DataFrame:
        return self.staged("marker_rel_ab_w_read_stats")

    @cached_property
    def unknown(self) -> DataFrame:
        return self.staged("metaphlan_unknown_list")


# Odd numeric strings with the double and the integer that a lenient warehouse cast gives.
ODD_NUMBERS: dict[str, tuple[float | None, int | None]] = {
    "1.0d": (None, None), "2f": (None, None), "0x1p3": (None, None), "0X1F": (None, 31), "1.5": (1.5, None),
    "-0x10": (None, -16), "0x000000000000000000ff": (None, 255), "abc": (None, None), "": (None, None),
    "12": (12.0, 12), "1e3": (1000.0, None), "-7": (-7.0, -7),
}


#: Files that the driver renames at once.
RENAMES = 32


def write_run(df: DataFrame, root: str, ds: schemas.Dataset, in_place: bool = False) -> str:
    """Write ``df`` in the layout of a run: ``<root>/<sample id>/<path tail>``, header lines without '#'.

    ``in_place``: where ``root`` is on a file system that tasks have mounted, they write the files there; else the driver moves them.
    """
    from concurrent.futures import ThreadPoolExecutor

    from taxaspark.sources.snapshots import FileAccess

    if in_place and on_local_files(df.sparkSession, root):
        write_sample_files(df, root, ds, "{}/" + ds.path_tail, mark="header")
        return root
    parts = write_raw_dataset(df, f"{root}.parts-{ds.name}", ds, mark="header")
    access = FileAccess(df.sparkSession, parts)
    to_path, fs = access.to, access.fs

    found = access.jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(to_path(f"{parts}/sample_id=*/part-*")))

    def rename(i: int) -> None:
        file = found[i]
        to = to_path(f"{root}/{file.getParent().getName()[len('sample_id='):]}/{ds.path_tail}")
        fs.mkdirs(to.getParent())
        if not fs.rename(file, to):
            raise OSError(f"{file} can't be renamed to {to}")

    with ThreadPoolExecutor(RENAMES) as pool:
        for _ in pool.map(rename, range(len(found))):
            pass
    return root


def on_local_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is on a mounted file system, which tasks can write to without Hadoop."""
    from taxaspark.sources.snapshots import FileAccess

    return FileAccess(spark, path).fs.getScheme() == "file"


def header_rows(df: DataFrame, ds: schemas.Dataset, n: int, mark: str) -> DataFrame:
    """``df`` (rows of any number) with ``_ord`` from -n to -1 and the raw columns of as many header lines."""
    cols = [f.name for f in ds.raw_schema.fields]
    first_text = F.when(F.col("_ord") == -1, F.lit("\t".join(cols))) \
        .otherwise(F.concat(F.lit(f"{mark} "), F.col("_ord").cast("string")))
    return (df.select("*", F.explode(F.sequence(F.lit(-n), F.lit(-1))).alias("_ord"))
              .select("*", first_text.alias(cols[0]), *[F.lit(None).cast("string").alias(c) for c in cols[1:]]))


def raw_rows(df: DataFrame, ds: schemas.Dataset, header_lines: int | None, mark: str) -> DataFrame:
    """``sample_id`` and the raw columns as texts, headers included: each sample's rows in one task, in order.

    The rows are dealt by a hash exchange on ``sample_id``; the
    header rows are made per sample with ``explode``, not a join.
    """
    n = ds.skip_rows if header_lines is None else header_lines
    cols = [f.name for f in ds.raw_schema.fields]
    df = df.withColumn("sample_id", F.nullif("sample_id", F.lit("")))  # both have the folder of no name: one file
    data = df.select("sample_id", F.lit(0).alias("_ord"), *[F.col(c).cast("string").alias(c) for c in cols])
    rows = data if n <= 0 else data.unionByName(header_rows(df.select("sample_id").distinct(), ds, n, mark))
    # An explicit count keeps AQE from coalescing the exchange: the work here is
    # one file per sample, so it should spread over every core, not over bytes.
    try:
        parts = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # no SparkContext on a Spark Connect client
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = planned_bytes(df)
    if size is not None and size < 1 << 60:
        parts = max(parts, -(-size // TASK_BYTES))
    order = ["sample_id", "_ord"] if n > 0 else ["sample_id"]
    return rows.repartition(parts, "sample_id").sortWithinPartitions(*order).drop("_ord")


#: Bytes of the inputs (Parquet: some ten times that as rows) that one task writes as samples.
TASK_BYTES = 16 * 1024 * 1024
CSV = {"sep": "\t", "quote": '"', "escape": '"'}


def write_sample_files(df: DataFrame, root: str, ds: schemas.Dataset, tail: str, header_lines: int | None = None,
                       mark: str = "#header") -> None:
    """One gzipped TSV per sample at ``<root>/<tail>``, whose ``{}`` is the sample's folder; for mounted file systems.

    Tasks write the files where they belong; with Spark's writer a file took longer than its rows, and the driver had to move it.
    A file appears whole, under its name; a task that is repeated replaces it.
    """
    cols = [f.name for f in ds.raw_schema.fields]
    top = local_path(root)
    line = F.concat(F.to_csv(F.struct(*cols), CSV), F.lit("\n"))
    n = ds.skip_rows if header_lines is None else header_lines
    heads = header_rows(df.sparkSession.range(1), ds, n, mark).orderBy("_ord").select(line.alias("line")).collect() if n > 0 else []
    head = "".join(r["line"] for r in heads).encode()  # the same in every file: no rows for it

    def write(batches):
        import gzip
        import os
        import uuid

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, temp, out, files = "", None, None, 0  # no folder's name is empty

        def folder_name(sample_id: str | None) -> str:
            """As ``partitionBy`` names it: characters that paths can't hold are %XX."""
            odd = "\"#%'*/:=?\\\x7f{[]^"
            return "".join(f"%{ord(c):02X}" if c < " " or c in odd else c for c in sample_id or "__HIVE_DEFAULT_PARTITION__")

        def done() -> None:
            if out is not None:
                out.close()
                os.replace(temp, os.path.join(top, tail.format(last)))

        for batch in batches:
            if not len(batch):
                continue
            lines = batch.column(1)
            offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + len(lines) + 1]
            text = memoryview(lines.buffers()[2])
            runs, i = pc.run_end_encode(batch.column(0)), 0
            for sample, j in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                name = folder_name(sample)
                if name != last:
                    done()
                    to = os.path.join(top, tail.format(name))
                    os.makedirs(os.path.dirname(to), exist_ok=True)
                    last, files = name, files + 1
                    temp = os.path.join(os.path.dirname(to), f".{uuid.uuid4().hex}.tmp")
                    out = gzip.open(temp, "wb", compresslevel=1)
                    out.write(head)
                out.write(text[offsets[i]:offsets[j]])
                i = j
        done()
        yield pa.RecordBatch.from_arrays([pa.array([files])], ["files"])

    rows = raw_rows(df, ds, 0, mark).select("sample_id", line.alias("line"))
    os.makedirs(top, exist_ok=True)
    rows.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def write_raw_dataset(df: DataFrame, root: str, ds: schemas.Dataset, header_lines: int | None = None,
                      mark: str = "#header", in_place: bool = False) -> str:
    """Write ``df`` (``sample_id`` + the raw columns) as raw per-sample files.

    One gzipped TSV per sample under ``<root>/sample_id=<id>/``, starting with
    ``ds.skip_rows`` header lines (all but the last begin with ``mark``).  Read
    them back with ``id_pattern=RAW_ID_PATTERN`` and ``paths=raw_glob(root)``.
    ``in_place`` as for ``write_run``.
    """
    if in_place and on_local_files(df.sparkSession, root):
        write_sample_files(df, root, ds, "sample_id={}/part-0.csv.gz", header_lines, mark)
        return root
    # Each task moves its own files into place: the driver would move them one by one.
    (raw_rows(df, ds, header_lines, mark).write.mode("overwrite").partitionBy("sample_id")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .options(**CSV).option("compression", "gzip").csv(root))
    return root


RAW_ID_PATTERN = r"/sample_id=([^/]+)/"


def raw_glob(root: str) -> str:
    return f"{root.rstrip('/')}/*/*.csv.gz"
