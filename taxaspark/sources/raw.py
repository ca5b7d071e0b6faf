"""Scans of raw per-sample profile files (one gzipped TSV per sample).

The read is ``wholetext``: one row per file, split into lines, the first N
lines dropped by position, then every line parsed with ``from_csv`` against the
declared schema.  Everything stays in the JVM, the header skip is exact
(independent of a comment character) and the ``sample_id`` derived from
``_metadata.file_path`` is a per-file constant, so a filter on it prunes files
at listing time.

Limit: a single raw file must fit in one value (~2 GB uncompressed).  The
line mode (``mode='lines'``) lifts it, with a Python step that numbers lines; ``mode='auto'`` takes
that way only for files that are large enough to pass the limit.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.functions.columns import sample_id_from_path
from taxaspark.schemas import DEFAULT_RUN_TAG, Dataset
from taxaspark.sources.snapshots import FileAccess

CSV_OPTIONS = {"sep": "\t", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def schema_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def dataset_glob(root: str, ds: Dataset) -> str:
    """Glob of one dataset's files: ``<root>/<sample dir>/<path tail>``."""
    return f"{root.rstrip('/')}/*/{ds.path_tail}"


LISTINGS = ("glob", "recursive")


LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: The most tasks that list folders.  Spark's default is one for each of up to 10,000 folders, and
#: starting a task takes longer than listing a sample's folder.
LISTING_TASKS = 400


#: Bytes of the driver's memory in which Spark keeps what the listings of all readers found, 250 MB by default.  A reader
#: looks for its own entries alone, so what one that isn't in use any more has left there is never used again.
KEPT_KEY = "spark.sql.hive.filesourcePartitionFileCacheSize"


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Folders are listed, when a reader is made in here, by ``LISTING_TASKS`` tasks at most, and four a core, and the driver
    forgets what they hold with the reader; the settings are put back."""
    try:
        most = min(LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism)
    except Exception:  # no SparkContext on a Spark Connect client
        most = LISTING_TASKS
    with held(spark, {LISTING_KEY: str(min(int(spark.conf.get(LISTING_KEY)), most)), KEPT_KEY: "0"}):
        yield


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]):
    """The session has these settings in here; they are put back."""
    kept = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


#: Folders whose files the driver knows at once.  It keeps about 1 KB for each file below them, of all datasets, in each
#: listing that a plan in use holds.
FOLDERS = 8192


def folder_groups(spark: SparkSession, root: str) -> list[list[str] | None]:
    """What lies right below ``root``, by name, in groups of ``FOLDERS`` to be listed one after the other; ``[None]`` if one listing will do.

    The driver then holds the names alone, and the files of a group or two (see ``one_by_one``).  Names that Spark's own listing skips are left out.
    """
    names = [n for n in FileAccess(spark, root).below(root) if not _skipped(n)]
    return [names[i:i + FOLDERS] for i in range(0, len(names), FOLDERS)] if len(names) > FOLDERS else [None]


def one_by_one(groups: list[list[str] | None]) -> Iterator[list[str] | None]:
    """The groups, each once the plans of the one before can be forgotten.

    PySpark notes where a column was made by way of Python's stack frames, which keep each other and the frames' DataFrames alive
    until Python looks for such cycles; the JVM keeps a plan, with its listing, for as long.
    """
    for folders in groups:
        yield folders
        if folders is not None:
            gc.collect()


def _skipped(name: str) -> bool:
    """Whether Spark's recursive listing passes over this name."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_common_metadata", "_metadata"))


def folder_paths(root: str, names: list[str]) -> list[str]:
    """Paths of a group's folders for a reader: what a path pattern would read into them is escaped."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", f"{root.rstrip('/')}/{n}") for n in names]


OPEN_KEY = "spark.sql.files.openCostInBytes"
#: Bytes that opening a raw file counts as.  With Spark's 4 MB a task of 16 MB takes four files of some KB, and the
#: driver keeps a record of each task of its last 1,000 stages.
OPEN_BYTES = 256 * 1024


def many_files_a_task(spark: SparkSession):
    """A context: jobs that run in it read small files in fewer tasks."""
    return held(spark, {OPEN_KEY: str(OPEN_BYTES)})


def _listed(spark: SparkSession, root: str, ds: Dataset, paths: str | list[str] | None, listing: str, folders: list[str] | None):
    """A reader for a dataset's files, and the paths that it is to list."""
    if paths is not None:
        return spark.read, paths
    if listing != "recursive":
        return spark.read, dataset_glob(root, ds)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", ds.path_tail.rsplit("/", 1)[-1])
    return reader, root if folders is None else folder_paths(root, folders)


def _read_text(spark: SparkSession, reader, where: str | list[str], whole: bool = False) -> DataFrame:
    # ``text()`` has its own ``wholetext`` argument, which overrides an option.
    with few_listing_tasks(spark):
        return reader.text(where, wholetext=whole)


def _strip_scheme(path: str) -> str:
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix):]
    return path


def layout_regex(root: str, ds: Dataset) -> str:
    """Regex a decoded file path must match to be ``<root>/<one folder>/<tail>`` of ``ds``."""
    return re.escape(_strip_scheme(root.rstrip("/"))) + "/[^/]+/" + re.escape(ds.path_tail) + "$"


def decoded_path(c: str = "file_path"):
    """``_metadata.file_path`` is a URI (a space is ``%20``); this is the plain path."""
    return F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))


def in_layout(root: str, ds: Dataset, c: str = "file_path"):
    """True for files that are exactly ``<root>/<one folder>/<tail>`` of ``ds``."""
    return decoded_path(c).rlike(layout_regex(root, ds))


def read_files(spark: SparkSession, root: str, ds: Dataset, listing: str = "glob", folders: list[str] | None = None) -> DataFrame:
    """One row per raw file of ``ds``: ``file_path`` and its whole text ``value``.

    ``glob`` expands ``<root>/*/<tail>`` on the driver, one directory listing
    per sample folder.  ``recursive`` lists ``root`` recursively with Spark's
    parallel file listing (a distributed job above a few dozen folders),
    keeps files named like the tail, then keeps only the exact
    ``<root>/<one folder>/<tail>`` layout; that path filter is applied while
    listing, so other files are never opened.  Prefer ``recursive`` for tens
    of thousands of sample folders on object storage.  ``folders`` (names from ``folder_groups``)
    restricts a recursive listing to these sample folders.
    """
    if listing not in LISTINGS:
        raise ValueError(f"listing must be one of {LISTINGS}")
    files = _read_text(spark, *_listed(spark, root, ds, None, listing, folders), whole=True)
    df = files.select(F.col("_metadata.file_path").alias("file_path"), F.col("value"))
    if listing == "recursive":
        df = df.where(in_layout(root, ds))
    return df


def line_numberer():
    """A ``mapInArrow`` function that appends ``_pos``, each row's 0-based line in its file.

    Rows arrive in file order and every file is read whole by one task (the
    caller guarantees non-splittable inputs), so a running count per path is
    exact; the state is one counter per file of the task.  Returned as a
    closure so it is shipped to the Python workers by value (they need not
    import this package).
    """
    def number_lines(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        seen = {}
        for batch in batches:
            paths = batch.column(batch.schema.get_field_index("file_path"))
            n = len(paths)
            if not n:
                continue
            # A run of rows is one file: borders are where a path differs from the one before.
            change = pc.not_equal(paths.slice(1), paths.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(change) + 1)
            sizes = np.diff(np.append(starts, n))
            base = np.empty(len(starts), np.int64)
            for i, (name, size) in enumerate(zip(paths.take(pa.array(starts)).to_pylist(), sizes)):  # one step a file
                base[i] = seen.get(name, 0)
                seen[name] = base[i] + size
            pos = np.arange(n) - np.repeat(starts - base, sizes)
            yield batch.append_column("_pos", pa.array(pos))
    return number_lines


def scan_lines_streamed(spark: SparkSession, paths: str | list[str] | DataFrame, skip_rows: int,
                        run_tag: str = DEFAULT_RUN_TAG, sample_ids: Iterable[str] | None = None,
                        id_pattern: str | None = None) -> DataFrame:
    """Same result as ``scan_lines`` for files of any size (no ~2 GB per-file cap).

    Lines are read by the line-based text reader and numbered per file in one
    Arrow pass.  Only gzip files are accepted: they are never split across
    tasks, which the numbering relies on; any other file fails the job.
    ``sample_ids`` is applied below the Python step, so it still prunes files;
    a filter written after this scan cannot move below that step, so pass
    sample restrictions as ``sample_ids`` in this mode.
    """
    if isinstance(paths, DataFrame):  # from ``read_lines``: file_path, line
        df = paths
    else:
        files = _read_text(spark, spark.read, paths)
        df = files.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"))
    df = df.withColumn("sample_id", sample_id_from_path("file_path", run_tag, id_pattern))
    if sample_ids is not None:
        df = df.where(F.col("sample_id").isin(list(sample_ids)))
    guard = F.when(F.col("file_path").endswith(".gz"), F.col("line")).otherwise(
        F.raise_error(F.concat(F.lit("line mode needs .gz input: "), F.col("file_path"))))
    df = df.select("file_path", "sample_id", guard.alias("line"))
    numbered = df.mapInArrow(line_numberer(), "file_path string, sample_id string, line string, _pos long")
    return (numbered.where((F.col("_pos") >= skip_rows) & (F.col("line") != ""))
                    .select("file_path", "sample_id", "line"))


def read_lines(spark: SparkSession, root: str, ds: Dataset, folders: list[str] | None = None) -> DataFrame:
    """Line-mode counterpart of ``read_files(listing='recursive')``: ``file_path``, ``line``."""
    files = _read_text(spark, *_listed(spark, root, ds, None, "recursive", folders))
    df = files.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"))
    return df.where(in_layout(root, ds))


def scan_lines(spark: SparkSession, paths: str | list[str] | DataFrame, skip_rows: int,
               run_tag: str = DEFAULT_RUN_TAG,
               sample_ids: Iterable[str] | None = None, id_pattern: str | None = None) -> DataFrame:
    """Data lines of every file after its first ``skip_rows`` lines.

    ``paths`` is a path / glob / list, or the result of ``read_files``.
    Columns: ``file_path``, ``sample_id`` (NULL when the path has no run tag),
    ``line``.  Blank lines (such as the one after a final newline) are dropped.
    ``sample_ids`` restricts the read to those samples' files; ``id_pattern``
    (regex, one group) overrides how the id is found in the path.
    """
    if isinstance(paths, DataFrame):
        df = paths
    else:
        files = _read_text(spark, spark.read, paths, whole=True)
        df = files.select(F.col("_metadata.file_path").alias("file_path"), F.col("value"))
    df = df.withColumn("sample_id", sample_id_from_path("file_path", run_tag, id_pattern))
    if sample_ids is not None:
        df = df.where(F.col("sample_id").isin(list(sample_ids)))
    lines = F.split(F.col("value"), r"\r\n?|\n")  # as the line reader ends lines
    body = F.slice(lines, skip_rows + 1, F.greatest(F.size(lines) - F.lit(skip_rows), F.lit(0)))
    return (df.select("file_path", "sample_id", F.explode(body).alias("line"))
              .where(F.col("line") != ""))


def parse_lines(lines: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse tab-separated ``line`` values against ``schema`` (FAILFAST).

    Typed columns are strict: a bad number, a short row or a long row fails
    the job.  Empty fields are NULL.
    """
    parsed = F.from_csv(F.col("line"), schema_ddl(schema), CSV_OPTIONS)
    return lines.select(*keep, parsed.alias("r")).select(*keep, *[F.col(f"r.{f.name}").alias(f.name)
                                                               for f in schema.fields])


READ_MODES = ("wholetext", "lines", "auto")
#: gzip expands at most 1,032 times, so a file below this many bytes is below 2 GiB as text.
WHOLE_BYTES = 2_000_000


def _text(spark: SparkSession, root: str, ds: Dataset, paths: str | list[str] | None, listing: str, whole: bool,
          folders: list[str] | None = None) -> DataFrame:
    """``file_path``, ``size`` and ``value`` (the file, or one line of it) of a dataset's files."""
    files = _read_text(spark, *_listed(spark, root, ds, paths, listing, folders), whole)
    files = files.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"), "value")
    return files.where(in_layout(root, ds)) if paths is None and listing == "recursive" else files


def has_large_files(spark: SparkSession, root: str, ds: Dataset, paths: str | list[str] | None = None, listing: str = "recursive",
                    bound: int = WHOLE_BYTES, folders: list[str] | None = None) -> bool:
    """Whether any file has ``bound`` bytes or more, from the listing alone: smaller files are dropped there and have no task."""
    reader, where = _listed(spark, root, ds, paths, listing, folders)
    with few_listing_tasks(spark):
        files = reader.format("binaryFile").load(where)
    return not files.where(F.col("_metadata.file_size") >= bound).select("path").isEmpty()


def dataset_lines_routed(spark: SparkSession, root: str, ds: Dataset, run_tag: str, sample_ids: Iterable[str] | None,
                         paths: str | list[str] | None, id_pattern: str | None, listing: str, bound: int = WHOLE_BYTES,
                         folders: list[str] | None = None) -> DataFrame:
    """Data lines, each file by the way that its size allows: below ``bound`` bytes in the JVM, else line by line.

    The size is a constant of a file, so a route opens its own files only; without a file of ``bound``
    bytes there is no Python step in the plan.
    """
    sample_ids = None if sample_ids is None else list(sample_ids)
    small = _text(spark, root, ds, paths, listing, True, folders).where(F.col("size") < bound).select("file_path", "value")
    lines = scan_lines(spark, small, ds.skip_rows, run_tag, sample_ids, id_pattern)
    if not has_large_files(spark, root, ds, paths, listing, bound, folders):
        return lines
    large = _text(spark, root, ds, paths, listing, False, folders).where(F.col("size") >= bound).select("file_path", F.col("value").alias("line"))
    return lines.unionByName(scan_lines_streamed(spark, large, ds.skip_rows, run_tag, sample_ids, id_pattern))


def dataset_lines(spark: SparkSession, root: str, ds: Dataset, run_tag: str = DEFAULT_RUN_TAG,
                  sample_ids: Iterable[str] | None = None, paths: str | list[str] | None = None,
                  id_pattern: str | None = None, listing: str = "recursive", mode: str = "wholetext",
                  folders: list[str] | None = None) -> DataFrame:
    """Unparsed data lines of one dataset (``file_path``, ``sample_id``, ``line``).

    ``mode='wholetext'`` (default) stays in the JVM; ``mode='lines'`` handles
    files beyond the ~2 GB single-value limit; ``mode='auto'`` chooses by each file's size.
    ``folders`` (names from ``folder_groups``) restricts a recursive listing to these sample folders.
    """
    if mode not in READ_MODES:
        raise ValueError(f"mode must be one of {READ_MODES}")
    if listing not in LISTINGS:
        raise ValueError(f"listing must be one of {LISTINGS}")
    if mode == "auto":
        return dataset_lines_routed(spark, root, ds, run_tag, sample_ids, paths, id_pattern, listing, folders=folders)
    if mode == "lines":
        if paths is None:
            paths = read_lines(spark, root, ds, folders) if listing == "recursive" else dataset_glob(root, ds)
        return scan_lines_streamed(spark, paths, ds.skip_rows, run_tag, sample_ids, id_pattern)
    source = paths if paths is not None else read_files(spark, root, ds, listing, folders)
    return scan_lines(spark, source, ds.skip_rows, run_tag, sample_ids, id_pattern)


def scan_ext(spark: SparkSession, root: str, ds: Dataset, run_tag: str = DEFAULT_RUN_TAG,
             sample_ids: Iterable[str] | None = None, paths: str | list[str] | None = None,
             id_pattern: str | None = None, listing: str = "recursive", mode: str = "wholetext",
             folders: list[str] | None = None) -> DataFrame:
    """The ``ext_*`` layer: raw typed rows plus their source ``file_path``."""
    lines = dataset_lines(spark, root, ds, run_tag, sample_ids, paths, id_pattern, listing, mode, folders)
    return parse_lines(lines, ds.raw_schema, keep=("file_path", "sample_id"))


def scan_src(spark: SparkSession, root: str, ds: Dataset, run_tag: str = DEFAULT_RUN_TAG,
             sample_ids: Iterable[str] | None = None, paths: str | list[str] | None = None,
             id_pattern: str | None = None, listing: str = "recursive", mode: str = "wholetext",
             folders: list[str] | None = None) -> DataFrame:
    """The ``src_*`` layer: ``sample_id`` from the path, then the raw columns."""
    return src_of(scan_ext(spark, root, ds, run_tag, sample_ids, paths, id_pattern, listing, mode, folders), ds)


def src_of(ext: DataFrame, ds: Dataset) -> DataFrame:
    """The ``src_*`` layer of an ``ext_*`` layer: the files aren't listed again."""
    return ext.select("sample_id", *[f.name for f in ds.raw_schema.fields])
