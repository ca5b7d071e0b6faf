"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.session import scratch_path

#: ASCII white space that separates words: space and \t \n \v \f \r.
#: ``bytes.split()`` splits at exactly these.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared ``spark.checkpoint.dir`` and read back.

    Cuts lineage: a lost executor costs only the tasks it ran, and nothing
    above the table is computed twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet (inputs may carry any extra columns)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_bytes(col: str = "text") -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the column's decimal text, modulo ``n`` (null id: text '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def join_checked(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                 max_rows: int = 100_000, salts: int = 16) -> DataFrame:
    """Null-safe equi join of a large side with a table of one row per key.

    ``right`` is counted first: up to ``max_rows`` rows it is broadcast, beyond
    that the join shuffles with ``salts`` copies of each right row, so that a
    key with a large share of the left rows is spread over as many tasks.
    """
    if right.count() <= max_rows:
        r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
        cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
        return left.join(F.broadcast(r), cond, how).drop(*[f"__r_{k}" for k in keys])
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    lhs = left.withColumn("__salt", salt)
    r = (right.withColumn("__r_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
         .select("__r_salt", *[F.col(k).alias(f"__r_{k}") for k in keys],
                 *[c for c in right.columns if c not in keys]))
    cond = [lhs["__salt"] == r["__r_salt"]] + [lhs[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    return lhs.join(r, cond, how).drop("__salt", "__r_salt", *[f"__r_{k}" for k in keys])


def running_sum(df: DataFrame, part: list[str], order: list[Column], value: Column, out: str,
                slices: int = 256, slice_key: Column | None = None) -> DataFrame:
    """Exclusive running sum of ``value`` inside each ``part`` without one task per part.

    Rows are cut into ``slices`` by ``slice_key`` (a value in [0, slices), default
    a hash of all columns).  Slice totals (at most parts x slices rows) get their
    own prefix sums, then each (part, slice) is summed by itself.  The order of a
    part is (slice, ``order``).
    """
    from pyspark.sql import Window as W

    key = slice_key if slice_key is not None else F.pmod(F.xxhash64(*df.columns), F.lit(slices))
    d = df.withColumn("__v", value).withColumn("__s", key.cast("int"))
    totals = d.groupBy(*part, "__s").agg(F.sum("__v").alias("__t"))
    before = F.sum("__t").over(W.partitionBy(*part).orderBy("__s").rowsBetween(W.unboundedPreceding, -1))
    starts = totals.select(*[F.col(p).alias(f"__p_{p}") for p in part], F.col("__s").alias("__ps"),
                           F.coalesce(before, F.lit(0)).alias("__b"))
    cond = [d["__s"] == starts["__ps"]] + [d[p] == starts[f"__p_{p}"] for p in part]
    inner = F.sum("__v").over(W.partitionBy(*part, "__s").orderBy(*order)
                              .rowsBetween(W.unboundedPreceding, -1))
    return (d.join(starts, cond).withColumn(out, F.col("__b") + F.coalesce(inner, F.lit(0)))
            .drop("__v", "__s", "__ps", "__b", *[f"__p_{p}" for p in part]))


def per_worker(key, make):
    """``make()`` once in a Python worker, kept for its later tasks (for read-only things such as vocabularies)."""
    import sys
    import types

    kept = sys.modules.setdefault("_taxaspark_worker", types.ModuleType("_taxaspark_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def byte_bpe(ranks_path: str, pattern: str, added: dict[str, int] | None = None, json_path: str | None = None):
    """``encode(text) -> ids`` of a byte-level BPE rank file; ids equal those of the JSON vocabulary it was made from.

    ``added`` holds that vocabulary's added tokens: their strings inside a text become
    their ids.  Without it such strings are ordinary text.  The rank file's pattern matcher gives up on runs
    of some hundred thousand white-space characters; such a text is encoded with the JSON file itself
    (``json_path``, by default the one beside the rank file), which takes twice the time.
    """
    import base64
    import os

    import numpy as np
    import tiktoken

    json_path = json_path or os.path.splitext(ranks_path)[0] + ".json"

    def whole():
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(json_path)
        found.encode_special_tokens = not added
        return found

    def load():
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added or {})

        def encode(text: str) -> np.ndarray:
            try:
                return fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # the matcher's stack
                slow = per_worker(("byte_bpe_json", json_path, bool(added)), whole)
                return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

        return encode

    return per_worker(("byte_bpe", ranks_path, pattern, json_path, *sorted((added or {}).items())), load)


def hot_bound(rows: int, least: int = 100_000, keys: int = 10_000) -> int:
    """Rows from which a key is hot: at most ``keys`` keys can have more, so a table of them may be broadcast."""
    return max(least, -(-rows // keys))


def numbered(df: DataFrame, part: list[str], order: list[str], out: str, least: int = 100_000) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... within each ``part`` (columns without nulls) by ``order``, nulls first.

    Parts up to ``hot_bound`` rows are numbered in a window each.  The rows of larger ones are dealt to
    ranges of the order, numbered inside their range and moved up by the ranges before.  Such parts are at most
    10,000, so the semi join with them and the range counts (ranges + parts) are broadcast.
    ``df`` must give the same rows each time.
    """
    from pyspark.sql import Window as W

    bound = hot_bound(df.count(), least)
    hot = written(df.groupBy(*part).agg(F.count("*").alias("__n")).where(F.col("__n") > bound).select(*part), "hot_parts")
    one = F.row_number().over(W.partitionBy(*part).orderBy(*order)) - 1
    if hot.isEmpty():
        return df.withColumn(out, one.cast("long"))
    cool = df.join(F.broadcast(hot), part, "left_anti").withColumn(out, one.cast("long"))
    keys = [F.col(c) for c in [*part, *order, "__task"]]  # the task spreads repeated rows
    rows = (df.join(F.broadcast(hot), part, "left_semi").withColumn("__task", F.spark_partition_id())
            .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__task")
            .withColumn("__at", F.monotonically_increasing_id()))
    rows = written(rows, "hot_ranges").withColumn("__range", F.shiftright("__at", 33))
    counts = rows.groupBy(*part, "__range").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy(*part).orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(*part, "__range", F.coalesce(before, F.lit(0)).alias("__before"))
    inner = F.row_number().over(W.partitionBy(*part, "__range").orderBy("__at")) - 1
    spread = (rows.withColumn("__inner", inner).join(F.broadcast(counts), [*part, "__range"])
              .withColumn(out, F.col("__before") + F.col("__inner")))
    return cool.unionByName(spread.select(*cool.columns))


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], least: int = 100_000) -> DataFrame:
    """Inner equi join of a written table with one of at most one row a key; a hot key of ``left`` meets in no one task.

    Keys with more than ``hot_bound`` left rows are at most 10,000, so their right rows are broadcast; all
    others are shuffled.  Null keys match nothing.
    """
    bound = hot_bound(left.count(), least)
    hot = written(left.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > bound).select(*keys), "hot_keys")
    if hot.isEmpty():
        return left.join(right, keys)
    few = written(right.join(F.broadcast(hot), keys, "left_semi"), "hot_rows")
    return left.join(F.broadcast(few), keys).unionByName(left.join(F.broadcast(hot), keys, "left_anti").join(right, keys))
