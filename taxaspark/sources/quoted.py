"""Delimited files whose quoted fields may hold line ends, read by many tasks.

Spark's ``multiLine`` reads a whole file in one task.  Here a file is read in blocks of lines, as any text:

1. Every line takes the reader from one state to another (outside or inside a quoted field).  A block's
   lines together are such a step too, so one pass gives, for each block, the state it ends
   in for either state it may start in: one row a block.
2. These steps are composed from block to block, which gives the state that each block starts in.
3. The second pass joins the lines of each record inside its block.  What reaches over a block's end
   is handed on as fragments (two a block at most), which are put together by file and order.

A quote opens a field only at its start, a doubled quote inside is a quote, and what follows a closing
quote up to the separator belongs to the field, as in Spark's own reader; a quote in
the middle of an unquoted field is text.  Line ends inside quotes are kept, a record's own may be LF or CRLF.  Compressed
files are one block each and are streamed.  Lines without a quote character are only counted, not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'


def ends_inside(line: str, inside: bool, sep: str, quote: str = QUOTE) -> bool:
    """Whether a quoted field is open after ``line``, that starts inside one or not."""
    at = 0
    while True:
        if not inside:  # at the start of a field
            if not line.startswith(quote, at):
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
            at += 1
        at = line.find(quote, at)
        if at < 0:
            return True
        if line.startswith(quote, at + 1):
            at, inside = at + 2, True
            continue
        at = line.find(sep, at + 1) + 1
        if not at:
            return False
        inside = False


#: Bytes that one task reads at least, where blocks are smaller.
TASK_BYTES = 32 * 1024 * 1024


def _lines(spark: SparkSession, path: str | list[str], block_bytes: int | None) -> DataFrame:
    """(file, block, line): lines in order within a block of a file; CR stays at a line's end.

    Many small blocks share a task; of a small input every core has a few tasks all the same.
    """
    if block_bytes:  # a session of its own: settings of the caller's stay as they are
        spark = spark.newSession()
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    text = spark.read.option("lineSep", "\n").text(path)
    if block_bytes and block_bytes < TASK_BYTES:
        from taxaspark.operators.staging import planned_bytes

        size = planned_bytes(text)
        if size is not None:
            text = text.select("value", "_metadata").coalesce(max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def _runs(batches):
    """(file, block, lines as Arrow) of each stretch of one block in the batches."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        files, blocks, lines = (batch.column(i) for i in range(3))
        place, at = (files[0].as_py(), blocks[0].as_py()), 0
        if place == (files[n - 1].as_py(), blocks[n - 1].as_py()) and len(blocks.unique()) == 1 and len(files.unique()) == 1:
            yield *place, lines
            continue
        for i in range(1, n + 1):
            here = (files[i].as_py(), blocks[i].as_py()) if i < n else None
            if here != place:
                yield *place, lines.slice(at, i - at)
                place, at = here, i


def _steps(batches, sep: str):
    """One row a block: the state it ends in when it starts outside, and when it starts inside a quoted field."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ends = {}
    for file, block, lines in _runs(batches):
        state = ends.setdefault((file, block), [False, True])
        for line in lines.filter(pc.match_substring(lines, QUOTE)).to_pylist():
            state[:] = [ends_inside(line, s, sep) for s in state]
    cols = list(zip(*[(f, b, *s) for (f, b), s in ends.items()])) or [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))],
                                     names=["file", "block", "outside", "inside"])


def _records(batches, sep: str, starts: BlockStarts | dict):
    """Records of each block; ``part`` is null for a whole one, else a fragment: 0 ends a record, 1 goes on, 2 begins one."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    place, inside, held, first = None, False, [], True

    def batch(texts, parts):
        n = len(texts)
        cols = [pa.array([place[0]] * n, pa.string()), pa.array([place[1]] * n, pa.int64()), pa.array(parts, pa.int32()),
                texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())]
        heads = np.zeros(n, bool)
        if n and first and place[1] == 0:
            heads[0] = True
        return pa.RecordBatch.from_arrays([*cols, pa.array(heads)], names=["file", "block", "part", "record", "header"])

    def last():
        """What a block leaves open, or its last record."""
        if held:
            middle = held[0] is None  # the block started inside a field that isn't closed yet
            text = "\n".join(held[1:] if middle else held)
            return batch([text], [1 if inside and middle else 0 if middle else 2 if inside else None])
        return None

    for file, block, lines in _runs(batches):
        if (file, block) != place:
            if place and (out := last()):
                yield out
            place, first = (file, block), True
            inside = starts[place]
            held = [None] if inside else []
        quoted = np.flatnonzero(pc.match_substring(lines, QUOTE).to_numpy(zero_copy_only=False))
        opens = np.empty(len(lines), bool)  # lines at whose start no field is open: they begin a record
        at = 0
        for i in quoted.tolist():
            opens[at:i + 1] = not inside
            inside = ends_inside(lines[i].as_py(), inside, sep)
            at = i + 1
        opens[at:] = not inside
        begin = np.flatnonzero(opens)
        if len(begin) == len(lines):  # each line begins a record; the last may go on
            if held:
                yield batch(["\n".join(held[1:] if held[0] is None else held)], [0 if held[0] is None else None])
                first = False
            if len(lines) > 1:
                yield batch(lines.slice(0, len(lines) - 1), [None] * (len(lines) - 1))
                first = False
            held = [lines[len(lines) - 1].as_py()]
            continue
        rows = lines.to_pylist()
        bounds = [*begin.tolist(), len(rows)]
        held += rows[:bounds[0]]
        texts, parts = [], []
        for a, b in zip(bounds, bounds[1:]):
            if held:
                middle = held[0] is None
                texts.append("\n".join(held[1:] if middle else held))
                parts.append(0 if middle else None)
            held = rows[a:b]
        if texts:
            yield batch(texts, parts)
            first = False
    if place and (out := last()):
        yield out


class BlockStarts:
    """``starts[file, block]``: does it start inside a quoted field.

    Every task gets this, so it holds the numbers of such blocks alone, eight bytes each.
    """

    def __init__(self, inside: dict[str, list[int]]):
        import numpy as np

        self.inside = {file: np.array(blocks, np.int64) for file, blocks in inside.items()}  # sorted

    def __getitem__(self, place: tuple[str, int]) -> bool:
        blocks = self.inside.get(place[0])
        if blocks is None:
            return False
        at = int(blocks.searchsorted(place[1]))
        return at < len(blocks) and int(blocks[at]) == place[1]

    def __bool__(self) -> bool:
        return bool(self.inside)


def block_starts(lines: DataFrame, sep: str) -> BlockStarts:
    """The blocks that start inside a quoted field; the driver sees one row a block."""
    from functools import partial

    steps = lines.mapInArrow(partial(_steps, sep=sep), "file string, block long, outside boolean, inside boolean")
    found, state, at = {}, False, None
    for file, block, outside, inside in sorted(tuple(r) for r in steps.collect()):
        state = state if file == at else False
        if state:
            found.setdefault(file, []).append(block)
        state, at = (inside if state else outside), file
    return BlockStarts(found)


def quoted_records(spark: SparkSession, path: str | list[str], sep: str, block_bytes: int | None = None) -> DataFrame:
    """(file, record, header) of every record of delimited text; ``header`` marks the first of each file.  Blank lines are left out."""
    from functools import partial

    lines = _lines(spark, path, block_bytes)
    starts = block_starts(lines, sep)
    found = lines.mapInArrow(partial(_records, sep=sep, starts=starts),
                             "file string, block long, part int, record string, header boolean")
    if not starts:
        whole = found.select("file", "record", "header")
    else:
        # Fragments: two a block at most.  A record is one value whatever its number of fragments.
        order = W.partitionBy("file").orderBy("block", "part").rowsBetween(W.unboundedPreceding, 0)
        pieces = found.where("part is not null").withColumn("nth", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(order))
        glued = pieces.groupBy("file", "nth").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "record"))), lambda p: p["record"]), "\n").alias("record"),
            F.max("header").alias("header"))
        whole = found.where("part is null").select("file", "record", "header").unionByName(glued.select("file", "record", "header"))
    record = F.regexp_replace("record", "\r$", "")
    return whole.withColumn("record", record).where("record != ''")


def read_quoted(spark: SparkSession, path: str | list[str], sep: str, schema: T.StructType, block_bytes: int | None = None) -> DataFrame:
    """Rows of delimited files with a header line each, against ``schema`` (FAILFAST); empty fields are NULL.

    A short or long row fails the read.
    """
    records = quoted_records(spark, path, sep, block_bytes).where(~F.col("header"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST", "multiLine": "true"}
    parsed = records.select(F.from_csv("record", ddl, options).alias("r"))
    return parsed.select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields])
