"""Balanced shards by label propagation.

Rows that share a link key are neighbours.  Linked rows start on shards by hash; in
each round every key's members are counted per shard, the members of weaker shards
want to move to the strongest one that has room, and the moves into a shard are
admitted up to its free capacity (an equal share of all bytes).  Unlinked rows have
no neighbours to keep, so they are placed last and make the shards even: from the
largest size class to the smallest, each class is spread over what room the shards
have left.  A group larger than a shard fills one and goes on in the next.

All steps are DataFrame operations.  Running sums are cut into slices with their own
totals, joins on link keys are broadcast below a counted bound or salted, so no key's
rows meet in one task; the driver sees one row a shard.

Defined cases: null text is empty and has size 1; repeated rows are rows of their
own (and linked to each other); an empty table gives an empty result; other columns
aren't read.  Texts of any length count by their bytes and are known by a digest; of shards with as many rows of a
key the one with the larger hash wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import join_checked, running_sum, text_bytes, written

SHARDS = 16
#: Lower ends of the size classes (bytes) that the unlinked rows are placed by, largest first.
CLASSES = (32_768, 4_096, 512, 0)
#: Rows of a slice of a running sum, about.
SLICE_ROWS = 50_000


def _slices(rows: int) -> int:
    return max(8, min(65_536, rows // SLICE_ROWS))


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["b"] for r in state.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _places(state: DataFrame) -> int:
    """A number that changes if any row changes its shard."""
    return state.agg(F.sum(F.pmod(F.xxhash64("rid", "shard"), F.lit(1 << 40)))).first()[0]


def _by_shard(values: list, shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard + 1)


def propagate(linked: DataFrame, capacity: int, shards: int = SHARDS, slices: int = 64) -> DataFrame:
    """(rid, key, size, shard) of rows (rid, key, size), whose rows of a key are drawn to one shard.

    No round lets a shard take in more bytes than it has free.  Rounds go on until no row can move: two or three, and one
    more for each shard that a large group fills.  They end, as a row only moves to a shard with as many of its
    key's rows or more, so the sum of the squares of these counts rises.
    """
    state = written(linked.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int")), "labels")
    while True:
        free = [max(0, capacity - b) for b in _loads(state, shards)]
        cells = written(state.groupBy("key", "shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "label_votes")
        # Most members first; between equals the key decides, so that all of them agree.
        rank = F.struct("n", F.xxhash64("key", "shard"))
        room = _by_shard(free, F.col("shard")) >= F.col("bytes") / F.col("n")  # for one more such row
        best = (cells.groupBy("key").agg(F.max(F.when(room, F.struct(rank.alias("rank"), F.col("shard").alias("to")))).alias("best"))
                .where("best is not null").select("key", F.col("best.rank").alias("rank"), F.col("best.to").alias("to")))
        wish = (cells.join(best, "key").where((F.col("shard") != F.col("to")) & (rank < F.col("rank")))
                .select("key", "shard", "to", "n", "bytes"))
        wish = written(wish, "label_moves")
        order = F.pmod(F.xxhash64("key"), F.lit(slices))
        queued = running_sum(wish, ["to"], [F.xxhash64("key", "shard")], F.col("bytes"), "start", slices, order)
        quota = (_by_shard(free, F.col("to")) - F.col("start")).alias("quota")
        admitted = written(queued.select("key", "shard", "to", "bytes", quota).where("quota > 0"), "label_quota")
        if admitted.isEmpty():
            break
        # A move that only fits in part takes its first rows; at most one key a shard does.
        moves = join_checked(state, admitted, ["key", "shard"])
        whole = moves.where("to is null or bytes <= quota").select("rid", "key", "size", F.coalesce("to", "shard").alias("shard"))
        part = written(moves.where("bytes > quota").select("rid", "key", "size", "shard", "to", "quota"), "label_part")
        part = running_sum(part, ["key", "shard"], [F.col("rid")], F.col("size"), "start", slices)
        part = part.select("rid", "key", "size", F.when(F.col("start") + F.col("size") <= F.col("quota"), F.col("to"))
                           .otherwise(F.col("shard")).alias("shard"))
        before, state = state, written(whole.union(part), "labels")
        if _places(before) == _places(state):  # the first row of each move that fits in part was too large
            break
    return state


def release(state: DataFrame, capacity: int, shards: int, slices: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows that stay, rows beyond their shard's capacity): whole keys go first in, so few are cut."""
    if max(_loads(state, shards)) <= capacity:
        return state, None
    queued = written(running_sum(state, ["shard"], [F.col("key"), F.col("rid")], F.col("size"), "start", slices,
                                 F.pmod(F.xxhash64("key", (F.xxhash64("rid") % 8)), F.lit(slices))), "label_over")
    fits = F.col("start") + F.col("size") <= capacity
    return queued.where(fits).drop("start"), queued.where(~fits).drop("start", "shard")


def fill(free_rows: DataFrame, loads: list[int], shards: int, slices: int) -> list[DataFrame]:
    """Places rows (rid, size) on the shards in proportion to what each still lacks."""
    capacity = -(-(sum(loads) + (free_rows.agg(F.sum("size")).first()[0] or 0)) // shards)
    placed, upper = [], None
    for lower in CLASSES:
        rows = free_rows.where(F.col("size") >= lower) if upper is None else free_rows.where((F.col("size") >= lower) & (F.col("size") < upper))
        upper = lower
        total = rows.agg(F.sum("size")).first()[0] or 0
        if not total:
            continue
        lack = [max(0, capacity - b) for b in loads]
        lack = lack if sum(lack) else [1] * shards
        ends = [total * sum(lack[:s + 1]) / sum(lack) for s in range(shards)]
        at = F.col("start") + F.col("size") / 2
        shard = reduce(lambda c, s: F.when(at < ends[s], F.lit(s)).otherwise(c), reversed(range(shards - 1)),
                       F.lit(max(s for s in range(shards) if lack[s])))
        done = written(running_sum(rows, [], [F.col("rid")], F.col("size"), "start", slices)
                       .select("rid", "size", shard.cast("int").alias("shard")), "shard_fill")
        loads = [a + b for a, b in zip(loads, _loads(done, shards))]
        placed.append(done)
    return placed


def balanced_shards(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(rid, shard) of every row of (rid, size, key): near equal bytes, rows of a key together.

    ``rid`` must be unique and ``rows`` a table that gives the same rows each time.
    """
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    slices = _slices(total["n"])
    capacity = (total["b"] or 0) // shards
    groups = rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    marked = written(join_checked(rows, written(groups, "link_groups"), ["key"]), "shard_rows")
    state = propagate(marked.where("members is not null").select("rid", "key", "size"), capacity, shards, slices)
    stay, over = release(state, capacity, shards, slices)
    loose = marked.where("members is null").select("rid", "size")
    if over is not None:
        loose = loose.union(over.select("rid", "size"))
    parts = [stay.select("rid", "size", "shard"), *fill(loose, _loads(stay, shards), shards, slices)]
    return reduce(DataFrame.union, parts).select("rid", "shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; equal texts are linked."""
    text = text_bytes()
    rows = written(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                               (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                               F.unhex(F.sha2(text, 256)).alias("key")), "shard_sizes")
    placed = balanced_shards(rows.select("rid", "size", "key"), shards)
    full = written(rows.drop("key").join(placed, "rid"), "shard_placed")
    slots = running_sum(full, ["shard"], [F.col("rid")], F.lit(1).cast("long"), "slot", _slices(full.count()))
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))
