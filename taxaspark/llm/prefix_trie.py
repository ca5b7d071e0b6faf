"""Prefix trie of conversations, rolled up in bands of depth.

A node is a distinct sequence of first turns; its key is its depth and a 120-bit hash of
the sequence (every turn hashed with its position, the hashes of a path joined by XOR, so
a path's keys are running sums).  Each node is counted once over all paths and is represented
by its smallest member, on whose path all its ancestors lie.

Sums over subtrees go upwards by bands of ``band`` depths:

1. within a band, every node adds its value to its ancestors of the same band only;
2. the band's top nodes then hold what lies in their band, and are themselves the nodes of a
   trie that is ``band`` times flatter: step 1 is repeated on it, until one band is left;
3. going back down, each top node whose total is complete adds it to its ancestors in the
   band above, which completes the totals there.

A node explodes to at most ``band`` ancestors a level, and depth D takes
2 log_band(D) rounds (one for conversations shorter than ``band``).

No key's rows meet in one task: turns are numbered by ``numbered``, paths are summed in blocks
of ``BLOCK`` turns, counts combine before they are shuffled, and parents with very many children are
joined by a broadcast of at most 10,000 rows.  The hash of a node's end members is sequential by
nature: large lists are joined into lines of ids in parallel, and one task then streams those lines.

Defined cases: rows without conv_id belong to no conversation and aren't read; a null role or text
is empty; a null turn comes first; rows of one turn number are ordered by role and the SHA-256 of role
and text; repeated rows are turns of their own; a conversation without turns ends at the root; an empty
table gives an empty result; other columns aren't read.  Texts of any length travel as digests.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taxaspark.llm.common import hot_bound, numbered, text_bytes, written

#: Depths of a band.
BAND = 16
#: Turns of one path that are summed in one window.
BLOCK = 4096
#: Ids of one line of a large list of end members.
LINE = 1024

KEY = ["depth", "a", "b"]
VALUES = ["n_children", "n_leaves", "saved"]


def turn_rows(conversations: DataFrame, least: int = 100_000) -> DataFrame:
    """(conv_id, at, digest, n_bytes) of every turn; ``at`` counts a conversation's turns from 0."""
    role, text = text_bytes("role"), text_bytes("text")
    digest = F.unhex(F.sha2(F.concat(F.concat(F.octet_length(role).cast("string"), F.lit(":")).cast("binary"), role, text), 256))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    rows = written(rows, "trie_turns")
    return written(numbered(rows, ["conv_id"], ["turn", "role", "digest"], "at", least).select("conv_id", "at", "digest", "n_bytes"),
                   "trie_ordered")


def rebuild(rows: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of their group's first one: (conv_id, depth, digest, n_bytes) of turns, (conv_id, length).

    The first h turns of conversation c are those of c - c % group, with h = crc32(c) % most.
    """
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.withColumns({"h": head, "first": F.col("conv_id") - F.col("conv_id") % group})
    firsts = convs.select(F.col("conv_id").alias("first"), F.col("n").alias("first_n"))
    take = F.least("h", F.coalesce("first_n", F.lit(0)))
    plan = written(convs.join(firsts, "first", "left").select("conv_id", "n", "h", "first", take.alias("take"),
                                                              (take + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
                   "trie_plan")
    heads = rows.where((F.col("at") < most) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "first")
    copied = (plan.where("take > 0").select("conv_id", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("take") - 1)).alias("at"))
              .join(heads, ["first", "at"]).select("conv_id", (F.col("at") + 1).alias("depth"), "digest", "n_bytes"))
    # A head shorter than h turns moves the own turns up; said once for each block of turns, so a long conversation is spread.
    block = F.floor(F.col("at") / BLOCK)
    moved = plan.where("take < h and n > h").select(
        "conv_id", (F.col("h") - F.col("take")).alias("up"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))).alias("block"))
    own = (rows.where(F.col("at") >= head).withColumn("block", block).join(moved, ["conv_id", "block"], "left")
           .select("conv_id", (F.col("at") + 1 - F.coalesce("up", F.lit(0))).alias("depth"), "digest", "n_bytes"))
    return copied.union(own), plan.select("conv_id", "length")


def paths(turns: DataFrame, lengths: DataFrame, deepest: int) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, n_bytes, ends) of every node on every path, the root at depth 0 included."""
    tag = F.md5(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(b":"), F.col("digest")))
    lane = [F.conv(F.substring(tag, i, 15), 16, 10).cast("long") for i in (1, 16)]
    rows = turns.select("conv_id", "depth", "n_bytes", lane[0].alias("la"), lane[1].alias("lb"),
                        F.floor(F.col("depth") / BLOCK).alias("block"))
    upto = W.partitionBy("conv_id", "block").orderBy("depth")
    run = upto.rowsBetween(W.unboundedPreceding, 0)
    if deepest >= BLOCK:
        rows = written(rows, "trie_lanes")
        sums = rows.groupBy("conv_id", "block").agg(F.bit_xor("la").alias("sa"), F.bit_xor("lb").alias("sb"))
        by_block = W.partitionBy("conv_id").orderBy("block")
        before = by_block.rowsBetween(W.unboundedPreceding, -1)
        carry = sums.select("conv_id", "block", F.coalesce(F.bit_xor("sa").over(before), F.lit(0)).alias("ca"),
                            F.coalesce(F.bit_xor("sb").over(before), F.lit(0)).alias("cb"),
                            F.lead("block").over(by_block).isNotNull().alias("more"))
        rows = rows.join(carry, ["conv_id", "block"])
    else:
        rows = rows.withColumns({"ca": F.lit(0).cast("long"), "cb": F.lit(0).cast("long"), "more": F.lit(False)})
    rows = rows.select("conv_id", "depth", "n_bytes", "la", "lb", F.bit_xor("la").over(run).bitwiseXOR(F.col("ca")).alias("a"),
                       F.bit_xor("lb").over(run).bitwiseXOR(F.col("cb")).alias("b"),
                       (F.lead("depth").over(upto).isNull() & ~F.col("more")).alias("ends"))
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"),
                           zero.alias("n_bytes"), (F.col("length") == 0).alias("ends"))
    return roots.unionByName(rows.select("conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("la")).alias("pa"),
                                         F.col("b").bitwiseXOR(F.col("lb")).alias("pb"), "n_bytes", "ends"))


def _band_rows(levels: int, band: int) -> Column:
    """The (level, band, closing) that a path's node at ``depth`` has a place in."""
    depth, out = F.col("depth"), []
    for level in range(levels):
        step = band ** (level + 1)
        top = F.floor(depth / step).cast("long")
        at = depth % (band ** level) == 0
        out.append(F.when(at, F.struct(F.lit(level).alias("level"), top.alias("band"), F.lit(False).alias("closing"))))
        if level + 1 < levels:  # the next band's top closes the band above it
            out.append(F.when((depth > 0) & (depth % step == 0),
                              F.struct(F.lit(level).alias("level"), (top - 1).alias("band"), F.lit(True).alias("closing"))))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _combined(parts: list[DataFrame]) -> DataFrame:
    """(KEY, conv_id, VALUES): rows of one node summed; only the node's own row names its conv_id."""
    return (reduce(DataFrame.unionByName, parts).groupBy(*KEY)
            .agg(F.max("conv_id").alias("conv_id"), *[F.sum(v).alias(v) for v in VALUES]))


def _upwards(edges: DataFrame, weights: DataFrame) -> DataFrame:
    """Each node's values added to the ancestors that its edge row lists."""
    sent = edges.join(weights.select("conv_id", "depth", *VALUES), ["conv_id", "depth"])
    return (sent.select(F.explode("above").alias("x"), *VALUES)
            .select("x.depth", "x.a", "x.b", F.lit(None).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("n_children"),
                    "n_leaves", "saved"))


def trie_nodes(path_rows: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """One row a node with its subtree's sums: (KEY, conv_id, pa, pb, n_convs, n_ends, n_children, n_leaves, saved).

    ``path_rows`` is a written table of ``paths``; a node (conv_id, depth) is named by its smallest member.
    """
    nodes = path_rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"),
        F.min("n_bytes").alias("n_bytes"), F.min("pa").alias("pa"), F.min("pb").alias("pb"))
    nodes = written(nodes, "trie_nodes")
    zero = F.lit(0).cast("long")
    own = nodes.select(*KEY, "conv_id", zero.alias("n_children"), (F.col("n_convs") == F.col("n_ends")).cast("long").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    children = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"),
                                               F.lit(None).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("n_children"),
                                               zero.alias("n_leaves"), zero.alias("saved"))
    levels = 1
    while band ** levels <= deepest:
        levels += 1
    # Paths of representatives, with the ancestors of each node inside each of its bands.
    reps = nodes.select("conv_id", "depth", F.lit(True).alias("rep"))
    placed = path_rows.select("conv_id", *KEY).join(reps, ["conv_id", "depth"], "left").select("*", F.explode(_band_rows(levels, band)).alias("at"))
    over = W.partitionBy("conv_id", "at.level", "at.band").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    edges = (placed.withColumn("above", F.collect_list(F.struct(*KEY)).over(over)).where("rep")
             .select("at.level", "at.closing", "conv_id", "depth", "above"))
    edges = written(edges, "trie_bands")

    def step(level, closing, weights):
        return _upwards(edges.where((F.col("level") == level) & (F.col("closing") == closing)), weights)

    partial = [written(_combined([own, children, step(0, False, own)]), "trie_sums")]
    for level in range(1, levels):
        tops = partial[-1].where(F.col("depth") % (band ** level) == 0)
        partial.append(written(_combined([tops, step(level, False, tops)]), "trie_sums"))
    total = partial[-1]
    for level in reversed(range(levels - 1)):
        total = written(_combined([partial[level], step(level, True, total)]), "trie_totals")
    return nodes.select(*KEY, "pa", "pb", "n_convs", "n_ends").join(total, KEY)


def _line_hashes(batches):
    """Streams lines of ids, sorted by node: one hash state at a time."""
    key, state = None, None
    for batch in batches:
        out = []
        for row in zip(*[batch.column(c).to_pylist() for c in (*KEY, "line")]):
            if row[:3] != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = row[:3], hashlib.sha256()
            else:
                state.update(b",")
            state.update(row[3].encode())
        yield _hash_batch(out)
    if state is not None:
        yield _hash_batch([(*key, state.hexdigest())])


def _hash_batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()])], names=[*KEY, "ends_sha256"])


def end_hashes(ends: DataFrame, nodes: DataFrame, convs: int, least: int = 10_000) -> DataFrame:
    """(KEY, ends_sha256) of every node at which conversations end, from ``ends`` (KEY, conv_id)."""
    bound = hot_bound(convs, least)
    large = written(nodes.where(F.col("n_ends") > bound).select(*KEY), "trie_large_ends")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    if large.isEmpty():
        return ends.groupBy(*KEY).agg(F.sha2(F.concat_ws(",", ids), 256).alias("ends_sha256"))
    small = (ends.join(F.broadcast(large), KEY, "left_anti").groupBy(*KEY)
             .agg(F.sha2(F.concat_ws(",", ids), 256).alias("ends_sha256")))
    rows = numbered(ends.join(F.broadcast(large), KEY, "left_semi"), KEY, ["conv_id"], "at", least)
    lines = (rows.groupBy(*KEY, F.floor(F.col("at") / LINE).alias("line_no")).agg(F.concat_ws(",", ids).alias("line"))
             .repartition(*KEY).sortWithinPartitions(*KEY, "line_no").select(*KEY, "line"))
    return small.union(lines.mapInArrow(_line_hashes, "depth long, a long, b long, ends_sha256 string"))


def parents(nodes: DataFrame, least: int = 100_000) -> DataFrame:
    """(KEY, parent_conv_id) of every node but the root; ``nodes`` is a written table."""
    up = nodes.select((F.col("depth")).alias("pd"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                      F.col("conv_id").alias("parent_conv_id"), "n_children")
    bound = hot_bound(nodes.count(), least)
    kids = nodes.where("depth > 0").select(*KEY, (F.col("depth") - 1).alias("pd"), "pa", "pb")
    on = ["pd", "pa", "pb"]
    large = up.where(F.col("n_children") > bound).drop("n_children")
    wide = kids.join(F.broadcast(large), on, "left")
    rest = wide.where("parent_conv_id is null").drop("parent_conv_id").join(up.where(F.col("n_children") <= bound).drop("n_children"), on)
    return wide.where("parent_conv_id is not null").unionByName(rest).select(*KEY, "parent_conv_id")


def conversation_trie(conversations: DataFrame, group: int = 5, most: int = 9, band: int = BAND, least: int = 100_000,
                      least_ends: int = 10_000) -> DataFrame:
    """All nodes of the trie of rebuilt conversations; see the module's text.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), all numbers long.
    """
    turns, lengths = rebuild(turn_rows(conversations, least), group, most)
    size = lengths.agg(F.count("*").alias("convs"), F.max("length").alias("deepest")).first()
    path_rows = written(paths(turns, lengths, size["deepest"] or 0), "trie_paths")
    nodes = written(trie_nodes(path_rows, size["deepest"] or 0, band), "trie_all")
    ends = path_rows.where("ends").select(*KEY, "conv_id")
    full = nodes.join(end_hashes(ends, nodes, size["convs"], least_ends), KEY, "left").join(parents(nodes, least), KEY, "left")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
