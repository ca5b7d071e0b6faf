"""End-to-end jobs: raw files → staged tables → lookups → exports → catalog.

Each step publishes a full-refresh Parquet table (``sources.snapshots``): readers see the old one
until the new one is whole, and a failed refresh leaves it.  One bad dataset does not
keep the others from being staged, nor one unreadable table the rest of the catalog.
Raw files are read by staging alone: the layer check goes by the rows counted there.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.operators.catalog import (
    EXTERNAL, TABLE, VIEW, TableEntry, catalog_summary, schema_catalog, table_profile, write_catalog_json,
)
from taxaspark.operators.checks import key_check, stack_layers
from taxaspark.operators.companions import for_dataset
from taxaspark.operators.staging import partitions_of, planned_bytes, staged_rows, write_table
from taxaspark.plans.exports import export_dataset
from taxaspark.schemas import (
    ACCESSIONS_TABLE, DATASETS, DEFAULT_RUN_TAG, SAMPLE_MAP_TABLE, Dataset,
)
from taxaspark.session import scratch_path
from taxaspark.sources.lookups import read_accessions, read_sample_map
from taxaspark.sources.raw import (
    dataset_glob, dataset_lines, folder_groups, layout_regex, many_files_a_task, one_by_one, scan_ext, scan_src, src_of,
)
from taxaspark.sources.snapshots import FileAccess, latest
from taxaspark.sources.tables import open_table, read_table, replace_table, table_path

EXPORTED = ("marker_abundance", "marker_presence", "marker_rel_ab_w_read_stats", "metaphlan_viruses_list")


@dataclass
class Config:
    raw_root: str                       # folder holding one sub-folder per sample
    warehouse: str                      # where stg_* and lookup tables are written
    export_root: str | None = None
    sample_map_csv: str | None = None
    accessions_path: str | None = None
    catalog_out: str | None = None
    run_tag: str = DEFAULT_RUN_TAG
    layout: str = "range"               # or "local" (see operators.staging.cluster)
    range_partitions: int | None = None  # default: from the input's bytes
    listing: str = "recursive"          # distributed listing; "glob" lists per folder on the driver
    read_mode: str = "auto"             # by file size; or "lines", "wholetext" (see sources.raw)
    max_partition_bytes: int | None = None  # compressed bytes per staging task (default: Spark's 128 MB)
    accessions_multiline: bool = True   # look for quoted newlines in the accession dump (one pass more)
    accessions_schema: str | None = None  # DDL; saves the text copy that the types are inferred with
    companions: bool = False            # publish names and sketches with each staged table (operators.companions)
    datasets: tuple[str, ...] = field(default_factory=lambda: tuple(DATASETS))


@dataclass
class Outcome:
    """What became of one table of a job: where it is, or why it wasn't refreshed."""
    table: str
    path: str
    error: str | None = None


def failed(result: dict) -> list[str]:
    """Messages of all failures in the result of a job (empty: all went well)."""
    found = []
    for value in result.values():
        if isinstance(value, Outcome) and value.error:
            found.append(f"{value.table}: {value.error}")
        elif isinstance(value, dict):
            found += failed(value)
    return found


def attempt(table: str, path: str, job) -> Outcome:
    """Run one table's job; its failure is kept, so that the other tables' jobs go on."""
    try:
        job()
        return Outcome(table, path)
    except Exception as exc:
        return Outcome(table, path, f"{type(exc).__name__}: {exc}")


# Views (src_*) -----------------------------------------------------------

def register_src_views(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Register lazy ``ext_*`` and ``src_*`` temp views over the raw files (replaced if present).

    ``ext_*`` has the raw columns plus ``file_path`` (the source file) and
    ``sample_id``; ``src_*`` has ``sample_id`` and the raw columns.
    """
    views = {}
    for name in cfg.datasets:
        ds = DATASETS[name]
        ext = scan_ext(spark, cfg.raw_root, ds, cfg.run_tag, listing=cfg.listing, mode=cfg.read_mode)
        for view, df in ((ds.ext_table, ext), (ds.src_view, src_of(ext, ds))):
            df.createOrReplaceTempView(view)
            views[view] = df
    return views


def register_tables(spark: SparkSession, warehouse: str) -> list[str]:
    """Register every written ``stg_*`` table and lookup as a temp view of the same name.

    SQL users then query them with ``spark.sql`` just as before; returns the names.
    """
    names = []
    for name in [ds.stg_table for ds in DATASETS.values()] + [SAMPLE_MAP_TABLE, ACCESSIONS_TABLE]:
        try:
            df = read_table(spark, warehouse, name)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):  # not written (yet); any other fault is the caller's to see
                continue
            raise
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


# J1-J5 / P2 ----------------------------------------------------------------

def stage_dataset(spark: SparkSession, cfg: Config, ds: Dataset) -> str:
    """Raw files of one dataset → ``stg_<name>`` table; returns its path.

    gzip input expands several times when read, so ``cfg.max_partition_bytes``
    can shrink the compressed bytes packed into one task (only for this job).

    The driver holds about 1 KB for each file of a listing.  Beyond ``sources.raw.FOLDERS`` sample folders they are listed
    and read group by group into a scratch folder, from which the table is then written, so each raw file is read once.
    """
    out = table_path(cfg.warehouse, ds.stg_table)
    if cfg.max_partition_bytes:  # a session of its own: settings of the caller's stay as they are
        spark = spark.newSession()
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(cfg.max_partition_bytes))
    groups = raw_groups(spark, cfg)

    def rows(folders: list[str] | None) -> DataFrame:
        return staged_rows(scan_src(spark, cfg.raw_root, ds, cfg.run_tag, listing=cfg.listing, mode=cfg.read_mode, folders=folders), ds)

    def write(df: DataFrame, partitions: int | None) -> None:
        write_table(df, out, cfg.layout, partitions, count_rows=True, companions=for_dataset(ds) if cfg.companions else None)

    if groups == [None]:
        write(rows(None), cfg.range_partitions)
        return out
    scratch, sizes = scratch_path(spark, ds.stg_table), []
    try:
        for folders in one_by_one(groups):
            some = rows(folders)
            sizes.append(planned_bytes(some))
            with many_files_a_task(spark):
                some.write.mode("append").parquet(scratch)
        size = None if None in sizes else sum(sizes)
        write(spark.read.schema(some.schema).parquet(scratch), cfg.range_partitions or partitions_of(spark, size))
    finally:
        FileAccess(spark, scratch).delete(scratch)
    return out


def raw_groups(spark: SparkSession, cfg: Config) -> list[list[str] | None]:
    """Sample folders that are listed at once (``sources.raw.folder_groups``); a glob is expanded as a whole."""
    return folder_groups(spark, cfg.raw_root) if cfg.listing == "recursive" else [None]


def stage_all(spark: SparkSession, cfg: Config) -> dict[str, Outcome]:
    """Stage every dataset, one job each; a dataset that fails keeps its old table and its error is returned."""
    return {ds.stg_table: attempt(ds.stg_table, table_path(cfg.warehouse, ds.stg_table),
                                   lambda ds=ds: stage_dataset(spark, cfg, ds))
            for ds in (DATASETS[n] for n in cfg.datasets)}


def verify_layers(spark: SparkSession, cfg: Config, name: str = "marker_abundance", recount: bool = False) -> DataFrame:
    """Row counts of ext / src / stg for one dataset (K1).

    ext and src are the rows that the staging job parsed (a malformed line fails it, so each line is one row)
    and ``expected_stg`` those with a sample id, as that job counted them; stg are the rows read back from the
    published files.  No raw file is opened.  ``recount`` reads the raw files as they are now instead,
    lines and parsed rows apart, which also shows whether the staged table is current.
    """
    ds = DATASETS[name]
    names = [ds.ext_table, ds.src_view, ds.stg_table]
    made = latest(spark, table_path(cfg.warehouse, ds.stg_table))
    if made and made.counts and not recount:
        rows, keyed = made.counts["rows"], made.counts["keyed"]
        wide = spark.createDataFrame([(rows, rows, made.rows, keyed)], "n0 long, n1 long, n2 long, keyed long")
        return stack_layers(wide, names, "expected_stg", {1: "keyed"})
    options = {"listing": cfg.listing, "mode": cfg.read_mode}
    lines = dataset_lines(spark, cfg.raw_root, ds, cfg.run_tag, **options)
    ext = lines.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(None).cast("bigint").alias("keyed"))
    src = scan_src(spark, cfg.raw_root, ds, cfg.run_tag, **options)
    # A hash of the whole row keeps every column in the scan.
    src = src.agg(F.count(F.xxhash64(*src.columns)).alias("n"), F.count("sample_id").alias("keyed"))
    stg = open_table(spark, table_path(cfg.warehouse, ds.stg_table))
    stg_n = stg.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(None).cast("bigint").alias("keyed"))
    parts = [df.select(F.lit(i).alias("i"), "n", "keyed") for i, df in enumerate((ext, src, stg_n))]
    wide = parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(
        *[F.max(F.when(F.col("i") == i, F.col("n"))).alias(f"n{i}") for i in range(3)], F.max("keyed").alias("keyed"))
    return stack_layers(wide, names, "expected_stg", {1: "keyed"})


# J6 / J7 / P3 --------------------------------------------------------------

def load_sample_map(spark: SparkSession, csv_path: str, warehouse: str) -> Row:
    """Sample map CSV → ``src_sample_id_map`` table; returns its key check (K2).

    The check is evaluated on what was written, before it takes the old table's place.
    """
    return replace_table(spark, table_path(warehouse, SAMPLE_MAP_TABLE), read_sample_map(spark, csv_path).write.parquet,
                         lambda df: key_check(df, "sample_id", "total_rows", "distinct_sample_ids").first(), ["sample_id"])


def load_accessions(spark: SparkSession, path: str, warehouse: str, multiline: bool = True,
                    max_records_per_file: int = 2_000_000, schema=None, block_bytes: int | None = None) -> Row:
    """Accession dump → snappy ``src_sra_accessions`` table; returns its key check.

    All columns are written, so a malformed row fails this job.
    """
    scratch = scratch_path(spark, "accession_texts")

    def write(to: str) -> None:
        rows = read_accessions(spark, path, multiline, schema, scratch, block_bytes)
        rows.write.option("compression", "snappy").option("maxRecordsPerFile", max_records_per_file).parquet(to)

    try:
        return replace_table(spark, table_path(warehouse, ACCESSIONS_TABLE), write,
                             lambda df: key_check(df, "Accession", "total_rows", "unique_accessions").first())
    finally:
        FileAccess(spark, scratch).delete(scratch)


def lookup_sample(spark: SparkSession, warehouse: str, name: str, n: int = 5) -> DataFrame:
    """Some rows of a lookup table, to look at after a load."""
    return read_table(spark, warehouse, name).limit(n)


def load_lookups(spark: SparkSession, cfg: Config) -> dict[str, Row | Outcome]:
    """Load both lookups; a table's key check, or the outcome of a load that failed (its old table stays)."""
    jobs = {}
    if cfg.sample_map_csv:
        jobs[SAMPLE_MAP_TABLE] = lambda: load_sample_map(spark, cfg.sample_map_csv, cfg.warehouse)
    if cfg.accessions_path:
        schema = T.StructType.fromDDL(cfg.accessions_schema) if cfg.accessions_schema else None
        jobs[ACCESSIONS_TABLE] = lambda: load_accessions(spark, cfg.accessions_path, cfg.warehouse,
                                                         cfg.accessions_multiline, schema=schema)
    checks = {}
    for table, job in jobs.items():
        out = attempt(table, table_path(cfg.warehouse, table), lambda: checks.__setitem__(table, job()))
        checks.setdefault(table, out)
    return checks


# X1-X4 ---------------------------------------------------------------------

def export_all(spark: SparkSession, cfg: Config) -> dict[str, Outcome]:
    """Export every exported dataset; one that fails is reported and the others go on."""
    def export(name: str, path: str) -> None:
        export_dataset(read_table(spark, cfg.warehouse, DATASETS[name].stg_table),
                       read_table(spark, cfg.warehouse, SAMPLE_MAP_TABLE), name, path)

    paths = {n: f"{cfg.export_root.rstrip('/')}/{n}" for n in EXPORTED if n in cfg.datasets}
    return {n: attempt(n, p, lambda n=n, p=p: export(n, p)) for n, p in paths.items()}


# K4-K7 / P4 ----------------------------------------------------------------

def catalog_entries(spark: SparkSession, cfg: Config) -> list[TableEntry]:
    """Every ext_*, src_* and stg_* object of the pipeline, plus the lookups.

    Nothing is opened here: the profile opens each object by itself and keeps its error.
    """
    groups = cache(lambda: raw_groups(spark, cfg))

    def scan(ds, folders=None):
        return scan_ext(spark, cfg.raw_root, ds, cfg.run_tag, listing=cfg.listing, folders=folders)

    def like(ds):  # for both layers; of very many folders one is listed
        return cache(lambda: scan(ds, groups()[0] and groups()[0][:1]))

    def rows(ds):
        return sum(scan(ds, folders).count() for folders in one_by_one(groups()))

    def table(name, **more):
        return TableEntry(name, TABLE, lambda: read_table(spark, cfg.warehouse, name),
                          path=table_path(cfg.warehouse, name), **more)

    entries = []
    for name in cfg.datasets:
        ds = DATASETS[name]
        uris = [dataset_glob(cfg.raw_root, ds)]
        ext, some = cache(lambda ds=ds: scan(ds)), like(ds)  # the whole is listed if somebody opens it
        entries.append(TableEntry(ds.ext_table, EXTERNAL, lambda ext=ext: ext().drop("file_path", "sample_id"),
                                  like=lambda some=some: some().drop("file_path", "sample_id"), count=lambda ds=ds: rows(ds),
                                  path=cfg.raw_root, files_glob=ds.path_tail.rsplit("/", 1)[-1],
                                  files_regex=layout_regex(cfg.raw_root, ds),
                                  external_config={"source_uris": uris, "num_source_uris": len(uris),
                                                   "source_format": "CSV", "compression": "GZIP",
                                                   "skip_leading_rows": ds.skip_rows, "field_delimiter": "\t"}))
        entries.append(TableEntry(ds.src_view, VIEW, lambda ext=ext, ds=ds: src_of(ext(), ds), like=lambda some=some, ds=ds: src_of(some(), ds),
                                  view_query=f"sample_id from path tag '{cfg.run_tag}' + {ds.ext_table}"))
        entries.append(table(ds.stg_table, clustering_fields=["sample_id"]))
    return entries + [table(n) for n in (SAMPLE_MAP_TABLE, ACCESSIONS_TABLE)]


def refresh_metadata(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    entries = catalog_entries(spark, cfg)
    profile = table_profile(spark, entries)
    schema = schema_catalog(spark, entries)
    summary = catalog_summary(profile)
    if cfg.catalog_out:
        write_catalog_json(profile, summary, schema, cfg.catalog_out)
    return {"profile": profile, "schema": schema, "summary": summary}


def run_all(spark: SparkSession, cfg: Config) -> dict:
    """P1: lookups, staging, layer check of every staged dataset, catalog, exports.

    Check results come back evaluated (a few rows each); tables, layer checks and the catalog are
    outcomes (see ``failed``), and a step that fails keeps no later one from running.
    """
    result = {"lookups": load_lookups(spark, cfg), "staged": stage_all(spark, cfg), "layers": [], "layer_checks": {}, "catalog": {}}
    for ds in (DATASETS[n] for n in cfg.datasets):
        if not result["staged"][ds.stg_table].error:
            result["layer_checks"][ds.name] = attempt(
                f"layers of {ds.name}", table_path(cfg.warehouse, ds.stg_table),
                lambda ds=ds: result["layers"].extend(verify_layers(spark, cfg, ds.name).orderBy("position").collect()))
    made = attempt("catalog", cfg.catalog_out or "", lambda: result["catalog"].update(refresh_metadata(spark, cfg)))
    if made.error:
        result["catalog"]["failure"] = made
    if cfg.export_root:
        result["exports"] = export_all(spark, cfg)
    return result


def refresh_staging(spark: SparkSession, cfg: Config) -> dict:
    """P2: staging plus the catalog."""
    return {"staged": stage_all(spark, cfg), "catalog": refresh_metadata(spark, cfg)}


def refresh_lookups(spark: SparkSession, cfg: Config) -> dict:
    """P3: the two lookup tables."""
    return load_lookups(spark, cfg)
