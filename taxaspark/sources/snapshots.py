"""Published folders: what readers see changes by one small atomic step.

    <path>/data/<unique>/...         what one job wrote; never changed afterwards
    <path>/_manifest/<number>.json   which folder a number stands for, with its files, rows and key ranges

A job writes a folder of its own, looks it over, and then creates the next manifest, which fails
if another job has taken that number (it then takes the one after, so of two refreshes at
once the later is what readers see, whole).  Readers take the highest manifest, so they always
find either the folder before or the one after.  The last ``KEEP`` folders stay, for readers that
still use them; folders that no manifest names (of jobs that died) go after ``ORPHAN_HOURS``.
A folder without manifests is read as it is.

Nothing but names goes through the driver; the manifests' figures come from one pass over the written files.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.session import local_path

KEEP = 3
ORPHAN_HOURS = 72
DATA, MANIFESTS = "data", "_manifest"
#: Schemes whose rename is atomic and fails if the target exists.
RENAMING = ("hdfs", "viewfs", "webhdfs")
#: Names that come from the JVM in one text.
NAMES = 10_000


@dataclass
class Manifest:
    folder: str                                   # below the published path
    rows: int | None = None
    keys: list[str] = field(default_factory=list)  # columns of the files' first and last key
    files: list[dict] = field(default_factory=list)  # name, rows, first, last; in the order of names
    counts: dict = field(default_factory=dict)     # of the job that wrote it
    number: int = 0

    def ordered(self) -> bool:
        """True if no file's key range reaches into the next one's."""
        def place(key):
            return [(v is not None, v) if v is not None else (False,) for v in key]

        return all(place(a["last"]) <= place(b["first"]) for a, b in zip(self.files, self.files[1:]))


class FileAccess:
    """The few file operations needed, on the file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.to = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.to(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what lies in a folder; empty if there is none."""
        try:
            return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(self.to(path))]
        except Py4JJavaError as exc:
            if exc.java_exception.getClass().getSimpleName() == "FileNotFoundException":
                return []
            raise

    def below(self, path: str) -> list[str]:
        """Names of what lies in a folder, sorted, of which there may be very many; empty if there is no such folder."""
        if self.fs.getScheme() == "file":
            try:
                with os.scandir(local_path(path)) as found:
                    return sorted(e.name for e in found if e.is_dir() or e.is_file())  # not a link to nowhere
            except (FileNotFoundError, NotADirectoryError):
                return []
        try:
            found = self.jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self.fs.listStatus(self.to(path)))
        except Py4JJavaError as exc:
            if exc.java_exception.getClass().getSimpleName() == "FileNotFoundException":
                return []
            raise
        names, n = [], len(found)
        for at in range(0, n, NAMES):  # a call for each name would take longer than the listing
            top = found[at].getParent().toString().rstrip("/") + "/"
            some = self.jvm.java.util.Collections.singletonList(found[at:at + NAMES]).toArray()
            text = self.jvm.java.util.Arrays.deepToString(some)  # [[<top>name, <top>name]]
            names += text[2 + len(top):-2].split(f", {top}")  # no name holds a slash
        return sorted(names)

    def read(self, path: str) -> str | None:
        try:
            stream = self.fs.open(self.to(path))
        except Py4JJavaError as exc:
            if exc.java_exception.getClass().getSimpleName() == "FileNotFoundException":
                return None
            raise
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, path: str, text: str) -> None:
        out = self.fs.create(self.to(path), False)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def create_new(self, path: str, text: str) -> bool:
        """Creates ``path`` with its whole content; False if it exists."""
        scheme = self.fs.getScheme()
        temp = f"{path}.{uuid.uuid4().hex}.tmp"
        if scheme == "file":  # a hard link fails if its name is taken
            plain = self.jvm.java.nio.file.Paths.get(self.to(temp).toUri().getPath(), self.jvm.java.lang.reflect.Array.newInstance(
                self.jvm.java.lang.Class.forName("java.lang.String"), 0))
            target = plain.resolveSibling(self.to(path).getName())
            nio = self.jvm.java.nio.file.Files
            self.fs.mkdirs(self.to(path).getParent())
            self._put(temp, text)
            try:
                nio.createLink(target, plain)
                return True
            except Py4JJavaError as exc:
                if exc.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                    return False
                raise
            finally:
                self.delete(temp)
        if scheme in RENAMING:
            self._put(temp, text)
            if self.fs.rename(self.to(temp), self.to(path)):
                return True
            self.delete(temp)
            return False
        try:  # object stores: an object appears whole when it is closed, and only if there is none
            self._put(path, text)
            return True
        except Py4JJavaError as exc:
            if self.fs.exists(self.to(path)):
                return False
            raise exc

    def delete(self, path: str) -> None:
        self.fs.delete(self.to(path), True)


def _numbers(files: FileAccess, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n, _ in files.names(f"{path}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit())


def _manifest_path(path: str, number: int) -> str:
    return f"{path}/{MANIFESTS}/{number:012d}.json"


def _load(files: FileAccess, path: str, number: int) -> Manifest | None:
    text = files.read(_manifest_path(path, number))
    return Manifest(**json.loads(text), number=number) if text else None


def latest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest that readers go by; None if nothing has been published at ``path``."""
    path = path.rstrip("/")
    files = FileAccess(spark, path)
    while True:
        numbers = _numbers(files, path)
        if not numbers:
            return None
        found = _load(files, path, numbers[-1])
        if found:  # else it expired since it was listed: there are newer ones
            return found


def folder(spark: SparkSession, path: str) -> str:
    """The folder that ``path`` stands for now; ``path`` itself if nothing has been published there."""
    found = latest(spark, path)
    return f"{path.rstrip('/')}/{found.folder}" if found else path


def batch_ends(keys: list[str]):
    """A ``mapInArrow`` function: of each run of rows of one file in a batch, its rows and its first and last key (nulls first).

    Returned as a closure so it is shipped to the Python workers by value.
    """
    def ends(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if not len(batch):
                continue
            run = pc.run_end_encode(batch.column("name"))
            begin = 0
            for name, end in zip(run.values.to_pylist(), run.run_ends.to_pylist()):
                rows = batch.slice(begin, end - begin)
                out = [pa.array([name]), pa.array([end - begin], pa.int64())]
                if keys:
                    order = pc.sort_indices(rows, sort_keys=[(k, "ascending") for k in keys], null_placement="at_start")
                    both = [rows.take(order[at:at + 1]).select(keys) for at in (0, len(rows) - 1)]
                    out += [pa.StructArray.from_arrays(b.columns, names=keys) for b in both]
                begin = end
                yield pa.RecordBatch.from_arrays(out, ["name", "rows", "first", "last"][:len(out)])

    return ends


def file_ends(df: DataFrame, keys: list[str]) -> DataFrame:
    """(name, rows, first, last) of each file of written Parquet.

    Spark aggregates texts by sorting all rows, unless some aggregate holds an object: with one key a set of one
    constant (``kept``) makes it go by hash, without Python.  With more keys tasks first take the ends of each batch
    as it comes; what is aggregated is some rows a file.
    """
    rows = df.select(F.col("_metadata.file_name").alias("name"), *keys)
    if not keys:
        return rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    if len(keys) == 1:
        key = F.struct(*keys)
        return rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"),
                                        F.collect_set(F.lit(0)).alias("kept"))
    kind = rows.select(F.struct(*keys).alias("k")).schema["k"].dataType.simpleString()
    ends = rows.mapInArrow(batch_ends(keys), f"name string, rows long, first {kind}, last {kind}")
    return ends.groupBy("name").agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))


def describe(df: DataFrame, keys: list[str]) -> tuple[int, list[dict]]:
    """(rows, files) of written Parquet: each file's rows and first and last key, by one pass over the key columns."""
    found = file_ends(df, keys).orderBy("name").collect()  # one row a file
    files = [{"name": r["name"], "rows": r["rows"], "first": list(r["first"]) if keys else [], "last": list(r["last"]) if keys else []}
             for r in found]
    return sum(f["rows"] for f in files), files


def publish(spark: SparkSession, path: str, write: Callable[[str], object], keys: list[str] | None = None,
            check: Callable[[DataFrame], object] | None = None, counts: Callable[[], dict] | None = None,
            accept: Callable[[Manifest], None] | None = None, keep: int = KEEP,
            companions: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> tuple[Manifest, object]:
    """Writes a folder and makes it what ``path`` stands for; (its manifest, what ``check`` returned).

    ``write`` gets the new folder.  Given ``keys`` (may be empty), the folder is Parquet: it is read back,
    ``check`` sees it, and the manifest lists its files with their ranges of ``keys``.  ``counts`` is asked after the write.
    ``companions`` are tables made from it, written inside the folder as ``_<name>``, which Parquet readers of the folder skip.
    ``accept`` may refuse the manifest by raising.  Any failure leaves what was published before.
    """
    path = path.rstrip("/")
    files = FileAccess(spark, path)
    made = Manifest(f"{DATA}/{uuid.uuid4().hex[:12]}")
    result = None
    try:
        write(f"{path}/{made.folder}")
        if keys is not None:
            fresh = spark.read.parquet(f"{path}/{made.folder}")
            made.keys = list(keys)
            made.rows, made.files = describe(fresh, made.keys)
            result = check(fresh) if check else None
            for name, make in (companions or {}).items():
                make(fresh).write.parquet(f"{path}/{made.folder}/_{name}")
        made.counts = counts() if counts else {}
        if accept:
            accept(made)
        body = asdict(made)
        body.pop("number")
        text = json.dumps(body, default=str)
        made.number = max(_numbers(files, path), default=0) + 1
        while not files.create_new(_manifest_path(path, made.number), text):
            made.number += 1
    except BaseException:
        files.delete(f"{path}/{made.folder}")
        raise
    expire(spark, path, keep)
    return made, result


def expire(spark: SparkSession, path: str, keep: int = KEEP, orphan_hours: float = ORPHAN_HOURS) -> None:
    """Drops all but the last ``keep`` published folders, and old ones that no manifest names."""
    path = path.rstrip("/")
    files = FileAccess(spark, path)
    numbers = _numbers(files, path)
    for number in numbers[:-keep]:
        old = _load(files, path, number)
        files.delete(_manifest_path(path, number))
        if old:
            files.delete(f"{path}/{old.folder}")
    named = {m.folder for m in (_load(files, path, n) for n in numbers[-keep:]) if m}
    limit = (time.time() - orphan_hours * 3600) * 1000
    for name, changed in files.names(f"{path}/{DATA}"):
        if changed < limit and f"{DATA}/{name}" not in named:
            files.delete(f"{path}/{DATA}/{name}")
