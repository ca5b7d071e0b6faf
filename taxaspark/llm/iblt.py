"""Document fingerprints as invertible Bloom lookup sketches of paragraphs.

A text is cut at line ends into paragraphs, and paragraphs of more than
``WORDS`` words into runs of that many; the distinct XXH64 digests of the parts are its set.  A sketch
has three tables of cells; a digest enters one cell of each, adding to the
cell's count and, by exclusive or, to its key and its check.  Subtracting two sketches leaves the
digests that differ, and peeling recovers them: a cell that holds a single
digest (count of one, matching check) gives it away, and it is taken out of its other
cells.  If cells are left over when peeling stops, the pair is sketched again four
times larger.  The likeness of two texts is the share of digests that they have in
common, from the sizes of the sets and the number of recovered differences.

The fingerprint is the smallest sketch, written in hex.

All of it is DataFrame operations: cells are rows, a peeling step is one explode
and one aggregate inside the partition of its document, without a shuffle.

Defined cases: null text is empty; two empty sets are alike (1.0), an empty one
and another aren't (0.0); texts of the same set have the same fingerprint; repeated rows are rows
of their own, each followed by the next row in order of id and text; an empty table gives an empty
result; other columns aren't read.  Texts of any length are read whole; ids may be any 64-bit numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taxaspark.llm.common import hot_bound, written

WORDS = 32
TABLES = 3
#: Cells of one table of the smallest sketch.
CELLS = 8
GROWTH = 4
#: Parts that the ids are cut into at most.
MOST_CUTS = 4096
#: Passes over the three tables in one peeling; what they leave is tried again larger.
PASSES = 4


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs, cut after every ``WORDS`` words."""
    parts = F.regexp_extract_all(text, F.lit(rf"(?:[^\s]+[^\S\n]*){{1,{WORDS}}}"), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(1))


def slot(key: Column, table: int, cells: Column) -> Column:
    """Cell of ``key`` in one of the tables of ``cells`` cells."""
    return F.lit(table).cast("long") * cells + F.pmod(F.xxhash64(key, F.lit(100 + table)), cells)


def sketch(elements: DataFrame, id_cols: list[str]) -> DataFrame:
    """Cells (id, cell, n, key, chk, cells) of rows (id, key, n, cells)."""
    entry = F.array(*[slot(F.col("key"), t, F.col("cells")) for t in range(TABLES)])
    return (elements.withColumn("cell", F.explode(entry))
            .groupBy(*id_cols, "cell", "cells")
            .agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor(check(F.col("key"))).alias("chk")))


def peel(cells: DataFrame, id_cols: list[str], keep: bool = True, passes: int = PASSES) -> DataFrame:
    """Recovers differences from subtracted sketches (id, cell, cells, n, key, chk).

    Each step takes the pure cells of one table, in which no digest can stand twice, and
    removes their digests from the other tables.  Recovered digests become rows of cell -1 (only
    in the first set) or -2 (only in the second) with the digest as ``found`` if ``keep``, else added up
    in ``n``.  What can't be recovered stays as cells from 0.
    """
    ids = ", ".join(id_cols)
    part = "named_struct('cell', {}, 'n', {}, 'key', {}, 'chk', {}, 'found', {})".format
    nothing = "cast(null as bigint)"
    gain = part("if(n > 0, -1L, -2L)", "1L", "0L", "0L", "key" if keep else nothing)
    steps = [f"s0 as (select {ids}, cells, cell, n, key, chk, {nothing} as found from {{cells}})"]
    for step in range(1, passes * TABLES + 1):
        t = step % TABLES
        out = [part(f"{u} * cells + pmod(xxhash64(key, {100 + u}), cells)", "-n", "key", "chk", nothing) for u in range(TABLES) if u != t]
        steps.append(f"""s{step} as (
  select {ids}, cells, c.cell, c.found, sum(c.n) as n, bit_xor(c.key) as key, bit_xor(c.chk) as chk
  from (select {ids}, cells, explode(
          case when cell between {t} * cells and {t + 1} * cells - 1 and abs(n) = 1 and chk = xxhash64(key, 1)
               then array({", ".join([gain, *out])}) else array({part("cell", "n", "key", "chk", "found")}) end) as c
        from s{step - 1} where cell < 0 or n <> 0 or key <> 0 or chk <> 0)
  group by {ids}, cells, c.cell, c.found)""")
    query = "with " + ",\n".join(steps) + f"\nselect * from s{passes * TABLES} where cell < 0 or n <> 0 or key <> 0 or chk <> 0"
    return cells.sparkSession.sql(query, cells=cells)


def _solve(pairs: DataFrame, id_cols: list[str], keep: bool, result) -> DataFrame:
    """``result`` of the peeled sketches of every pair, each pair at the first size that solves it."""
    solved = []
    # Half a cell of each table for every digest on both sides is enough for nearly all pairs.
    size = F.greatest(F.lit(CELLS), F.ceil((F.size("a") + F.size("b")) / 2)).cast("long")
    pairs = pairs.withColumn("cells", size)
    while True:
        side = lambda c, n: F.transform(F.col(c), lambda k: F.struct(k.alias("key"), F.lit(n).cast("long").alias("n")))
        items = (pairs.repartition(*id_cols).select(*id_cols, "cells", F.explode(F.concat(side("a", 1), side("b", -1))).alias("e"))
                 .select(*id_cols, "cells", F.col("e.key").alias("key"), F.col("e.n").alias("n")))
        done = written(result(peel(sketch(items, id_cols), id_cols, keep)), "iblt_peeled")
        solved.append(done.where("not unsolved").drop("unsolved"))
        failed = done.where("unsolved").select(*id_cols).distinct()
        if failed.isEmpty():
            return reduce(DataFrame.union, solved)
        pairs = written(pairs.join(failed, id_cols, "left_semi").withColumn("cells", F.col("cells") * GROWTH), "iblt_failed")


def differences(pairs: DataFrame, id_cols: list[str]) -> DataFrame:
    """(id, found, n): every digest that only one of the two sets ``a``, ``b`` holds; n is 1 for ``a``, -1 for ``b``.

    ``pairs``: (id, a, b) with one row an id.  Sketches grow until each pair is solved.
    """
    left = F.max(F.col("cell") >= 0).over(W.partitionBy(*id_cols))
    return _solve(pairs, id_cols, True, lambda state: state.withColumn("unsolved", left).select(
        *id_cols, "found", F.when(F.col("cell") == -1, 1).otherwise(-1).alias("n"), "unsolved"))


def difference_counts(pairs: DataFrame, id_cols: list[str]) -> DataFrame:
    """(id, differing): how many digests ``differences`` would give for each pair that differs."""
    return _solve(pairs, id_cols, False, lambda state: state.groupBy(*id_cols).agg(
        F.sum(F.when(F.col("cell") < 0, F.col("n")).otherwise(0)).alias("differing"), F.max(F.col("cell") >= 0).alias("unsolved")))


def likeness(size_a: Column, size_b: Column, differing: Column) -> Column:
    """Share of the common ones in the union of two sets."""
    return F.when(size_a + size_b == 0, F.lit(1.0)).otherwise(
        (size_a + size_b - differing).cast("double") / (size_a + size_b + differing))


def in_hex(sets: DataFrame, id_cols: list[str]) -> DataFrame:
    """(id, fingerprint): the smallest sketch of the set ``a``, its used cells in order: place, count, key, check."""
    items = sets.select(*id_cols, F.explode("a").alias("key"), F.lit(1).cast("long").alias("n"), F.lit(CELLS).cast("long").alias("cells"))
    cell = F.concat(F.lpad(F.hex("cell"), 2, "0"), F.lpad(F.hex("n"), 8, "0"), F.lpad(F.hex("key"), 16, "0"),
                    F.substring(F.lpad(F.hex("chk"), 16, "0"), 13, 4))
    return (sketch(items, id_cols).select(*id_cols, F.lower(cell).alias("c"))
            .groupBy(*id_cols).agg(F.concat_ws("", F.array_sort(F.collect_list("c"))).alias("fingerprint")))


def following(numbers: DataFrame, per_task: int = 1_024) -> DataFrame:
    """(bucket, then) of distinct bucket numbers in ascending order; the first follows the last.

    Neighbours are found inside stretches of ``per_task`` numbers, and between stretches.
    """
    d = numbers.withColumn("stretch", F.floor(F.col("bucket") / F.lit(per_task)))
    inner = d.withColumn("then", F.lead("bucket").over(W.partitionBy("stretch").orderBy("bucket")))
    starts = d.groupBy("stretch").agg(F.min("bucket").alias("start"))
    starts = starts.withColumn("next_start", F.lead("start").over(W.orderBy("stretch")))
    first = numbers.agg(F.min("bucket")).first()[0]
    return (inner.join(starts, "stretch")
            .select("bucket", F.coalesce("then", "next_start", F.lit(first)).cast("long").alias("then")))


def places(docs: DataFrame, buckets: int) -> Column:
    """A number for each row of (doc_id, mixed) that rises with doc_id and cuts the rows into about ``buckets`` parts.

    Cuts are quantiles of the ids (at most ``MOST_CUTS``), so ids may lie anywhere.  An id with more rows than two
    parts is cut by slices of ``mixed`` (the hash of the text), and so are rows without an id, which come first; of
    those, the copies of one text that hold more than ``hot_bound`` rows are dealt by scan task.
    """
    buckets = max(1, min(buckets, MOST_CUTS))
    found = docs.agg(F.count("*").alias("n"), F.percentile_approx("doc_id", [i / buckets for i in range(buckets)], 10 * buckets).alias("cuts")).first()
    many = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > max(1, 2 * found["n"] // buckets))
    many = [r["doc_id"] for r in many.collect()]  # at most half as many as parts
    wide = [i for i in many if i is not None]
    bounds = sorted({*(found["cuts"] or []), *wide}) or [0]
    groups = [bounds[i:i + 64] for i in range(0, len(bounds), 64)]
    heads = F.split(F.lit(",".join(str(g[0]) for g in groups)), ",").cast("array<bigint>")
    inner = F.transform(F.split(F.lit(";".join(",".join(map(str, g)) for g in groups)), ";"), lambda g: F.split(g, ",").cast("array<bigint>"))
    upto = lambda values: F.size(F.filter(values, lambda x: x <= F.col("doc_id")))
    group = F.greatest(upto(heads), F.lit(1))
    place = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise((group - 1) * 64 + upto(F.element_at(inner, group)) + 1).cast("long")
    sliced = F.col("doc_id").isNull() | F.col("doc_id").isin(wide) if wide else F.col("doc_id").isNull()
    number = place * 4097 + F.when(sliced, F.shiftright("mixed", 52) + 2048).otherwise(F.lit(4096))
    if many:
        copies = docs.groupBy("doc_id", "mixed").agg(F.count("*").alias("n")).where(F.col("n") > hot_bound(found["n"]))
        hot = [r["mixed"] for r in copies.select("mixed").distinct().collect()]  # at most 10,000
        if hot:
            number = number * 64 + F.when(sliced & F.col("mixed").isin(hot), 1 + F.pmod(F.spark_partition_id(), F.lit(63))).otherwise(F.lit(0))
    return F.coalesce(number, F.lit(0)).cast("long")


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (doc_id, text, set) with next_text and next_set of the row next by ascending id; the first follows the last.

    Inside a part of ``places`` the next row is one window step away, and the first row of the next part follows its last.
    Rows of one id are in order of their part and a hash; those without an id come first.  The texts are shuffled once.
    """
    mixed = F.xxhash64("text")
    # The last value of ``places`` is never used: it makes the column non-null, so that no branch below filters it and all share one shuffle.
    rows = docs.withColumn("mixed", mixed)
    rows = rows.withColumn("bucket", places(docs.select("doc_id", mixed.alias("mixed")), buckets))
    follow = W.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "mixed")
    steps = rows.select("bucket", "doc_id", "text", "set", F.lead("text").over(follow).alias("next_text"),
                        F.lead("set").over(follow).alias("next_set"), F.lag("mixed").over(follow).alias("before"))
    chain = written(following(rows.select("bucket").distinct()), "iblt_chain")
    firsts = steps.where("before is null").select(F.col("bucket").alias("then"), F.col("text").alias("t"), F.col("set").alias("s"))
    lasts = steps.where("next_text is null").select("bucket", "doc_id", "text", "set")
    wrapped = lasts.join(chain, "bucket").join(firsts, "then").select("doc_id", "text", "set", F.col("t").alias("next_text"), F.col("s").alias("next_set"))
    return steps.where("next_text is not null").select("doc_id", "text", "set", "next_text", "next_set").union(wrapped)


def fingerprint_documents(docs: DataFrame, bucket_rows: int = 1_024) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    # A cast that does nothing would hide that the branches of ``with_next`` read the same rows.
    doc_id = F.col("doc_id") if docs.schema["doc_id"].dataType.simpleString() == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text"))
    buckets = max(1, -(-docs.count() // bucket_rows))
    half = "cast(floor(length(text) / 2) as int)"
    edited = F.expr(f"concat(substring(text, 1, length(text) - {half}), substring(next_text, 1, {half}))")
    sets = written(with_next(rows.withColumn("set", digests(F.col("text"))), buckets)
                   .select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.length("text").cast("long").alias("n_chars"),
                           F.sha2(edited.cast("binary"), 256).alias("edited_sha256"), "set", digests(edited).alias("edited_set"),
                           "next_set"), "iblt_sets")
    pair = lambda other, b: F.struct(F.lit(other).alias("other"), F.col(b).alias("b"))
    pairs = (sets.select("rid", F.col("set").alias("a"), F.explode(F.array(pair("edited", "edited_set"), pair("next", "next_set"))).alias("p"))
             .select("rid", "p.other", "a", "p.b"))
    counts = difference_counts(pairs, ["rid", "other"])
    counts = counts.groupBy("rid").agg(F.max(F.when(F.col("other") == "edited", F.col("differing"))).alias("d_edited"),
                                       F.max(F.when(F.col("other") == "next", F.col("differing"))).alias("d_next"))
    both = sets.select("rid", F.explode(F.array(F.struct(F.lit("own").alias("which"), F.col("set").alias("a")),
                                                F.struct(F.lit("edited").alias("which"), F.col("edited_set").alias("a")))).alias("s"))
    prints = in_hex(both.select("rid", "s.which", "s.a").repartition("rid"), ["rid", "which"])
    prints = prints.groupBy("rid").agg(F.max(F.when(F.col("which") == "own", F.col("fingerprint"))).alias("fingerprint"),
                                       F.max(F.when(F.col("which") == "edited", F.col("fingerprint"))).alias("edited_fingerprint"))
    d = lambda c: F.coalesce(c, F.lit(0))
    small = sets.select("rid", "doc_id", "n_chars", "edited_sha256", F.size("set").alias("k"), F.size("edited_set").alias("k_edited"),
                        F.size("next_set").alias("k_next"))
    return (small.join(counts, "rid", "left").join(prints, "rid", "left")
            .select("doc_id", "n_chars", "edited_sha256", F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
                    F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
                    likeness(F.col("k"), F.col("k_edited"), d(F.col("d_edited"))).alias("near_edited"),
                    likeness(F.col("k"), F.col("k_next"), d(F.col("d_next"))).alias("near_next")))
