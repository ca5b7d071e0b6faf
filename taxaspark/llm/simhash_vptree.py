"""SimHash near-duplicates by vantage-point trees.

Fingerprints are 64-bit SimHashes of word shingles.  A routing tree is built on
a bounded sample of the distinct fingerprints: each inner node holds a vantage
point and a radius, and cuts the rest by Hamming distance to it.  Every
fingerprint is owned by one leaf, and also visits each leaf that the triangle
bound can't rule out (distance to the vantage point within ``max_bits`` of the
radius), so every pair meets somewhere whatever the sample was.  Inside a leaf the
same tree is grown further in memory and its ends are compared exactly.
A leaf task reports a spanning forest of its links, never all pairs; alternating
star contraction joins the forests to components.

Defined cases: null or empty text has fingerprint 0 and is linked like any
other; a text shorter than one shingle is hashed whole; a null id never names a
component unless all its ids are null; repeated rows share a fingerprint; an
empty table gives an empty result; other columns of the input are not read.  Texts of any length are
read whole, in the memory of one task; a bit set in exactly half the shingles is 0.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import fresh, text_bytes, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: The routing tree is built on about this many distinct fingerprints, chosen by hash.
SAMPLE = 16_384
#: Fingerprints a routing leaf should own; a leaf that owns more is dealt to several tasks.
LEAF = 4_096
#: In memory, groups below this many comparisons are compared directly.
DIRECT = 1 << 20


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    if n < shingle:
        pieces = [b" ".join(words)]
    else:
        pieces = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.array(list(map(xxhash.xxh64_intdigest, pieces, repeat(SEED))), np.uint64)
    ones = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(len(h), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of a binary text column as a signed long."""

    @F.arrow_udf("bigint")
    def hashed(texts: pa.Array) -> pa.Array:
        out = np.array([simhash(t.as_py(), shingle) for t in texts], np.uint64)
        return pa.array(out.view(np.int64))

    return hashed(text)


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Node:
    """Vantage point, radius and the two sides; or a leaf with a number."""

    def __init__(self, leaf: int | None = None, point=None, radius: int = 0, near=None, far=None):
        self.leaf, self.point, self.radius, self.near, self.far = leaf, point, radius, near, far


def pick_split(fps: np.ndarray, rng: np.random.Generator, tries: int = 8):
    """The candidate vantage point whose distances spread most, and its median distance."""
    best = None
    probe = fps if len(fps) <= 512 else rng.choice(fps, 512, replace=False)
    for point in rng.choice(fps, min(tries, len(fps)), replace=False):
        spread = distance(probe, point).std()
        if best is None or spread > best[0]:
            best = (spread, point)
    point = best[1]
    d = distance(fps, point)
    radius = int(np.median(d))
    if (d <= radius).all():  # ties at the top: cut below the largest distance
        radius = int(d.max()) - 1
    return point, radius, d


def grow(sample: np.ndarray, leaves: int, rng: np.random.Generator) -> tuple[Node, int]:
    """Routing tree with about ``leaves`` leaves, numbered from left to right."""
    counter = iter(range(1 << 30))

    def build(fps: np.ndarray, want: int) -> Node:
        if want <= 1 or len(fps) < 16:
            return Node(leaf=next(counter))
        point, radius, d = pick_split(fps, rng)
        near = d <= radius
        if near.all() or not near.any():
            return Node(leaf=next(counter))
        left = build(fps[near], want - want // 2)
        return Node(point=point, radius=radius, near=left, far=build(fps[~near], want // 2))

    root = build(sample, leaves)
    return root, next(counter)


def route(root: Node, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, leaf, owned) for each leaf that a fingerprint owns or may have a neighbour in.

    A pair is sought in one leaf only: a fingerprint visits leaves right of its own.
    """
    found, stack = [], [(root, np.arange(len(fps)), np.ones(len(fps), bool))]
    while stack:
        node, index, own = stack.pop()
        if not len(index):
            continue
        if node.leaf is not None:
            found.append((index, np.full(len(index), node.leaf, np.int32), own))
            continue
        d = distance(fps[index], node.point).astype(np.int16)
        # Right first off the stack doesn't matter; owners go left if d <= radius.
        mine = own & (d <= node.radius)
        # Going left is only needed by those that belong there or entered from a leaf further left.
        left = mine | (~own & (d <= node.radius + bits))
        right = (own & (d > node.radius)) | (d > node.radius - bits)
        stack.append((node.near, index[left], mine[left]))
        stack.append((node.far, index[right], (own & (d > node.radius))[right]))
    if not found:
        return np.zeros(0, int), np.zeros(0, np.int32), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found))


def hook(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the label sets of linked positions, in place: smallest position wins."""
    while len(u):
        a, b = labels[u], labels[v]
        open_ = a != b
        if not open_.any():
            return
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        low = np.minimum(a, b)
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def link(fps: np.ndarray, owned: np.ndarray, bits: int, rng: np.random.Generator) -> np.ndarray:
    """For each fingerprint the position of its local component's first member.

    Links between an owned and any fingerprint count.  The vantage-point cut goes on in
    memory until a block is small enough to compare each of its pairs.
    """
    labels = np.arange(len(fps))
    stack = [(np.flatnonzero(owned), np.arange(len(fps)), 0)]
    while stack:
        own, ask, depth = stack.pop()
        if not len(own) or not len(ask):
            continue
        if len(own) * len(ask) > DIRECT and depth < 40:
            point, radius, d = pick_split(fps[own], rng)
            near = d <= radius
            if near.any() and not near.all():
                e = distance(fps[ask], point).astype(np.int16)
                sides = ((own[near], ask[e <= radius + bits]), (own[~near], ask[e > radius - bits]))
                if max(len(o) * len(a) for o, a in sides) < 0.9 * len(own) * len(ask):
                    stack += [(o, a, depth + 1) for o, a in sides]
                    continue
        step = max(1, DIRECT // len(own))
        for i in range(0, len(ask), step):
            rows = ask[i:i + step]
            close = distance(fps[rows][:, None], fps[own][None, :]) <= bits
            close &= labels[rows][:, None] != labels[own][None, :]
            r, c = np.nonzero(close)
            hook(labels, rows[r], own[c])
    return labels


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node in ``edges`` (a, b), by alternating star contraction.

    Every round rewrites the edges towards the smallest node in reach and writes
    them to the shared folder; it ends when a round changes nothing.
    """
    state, last = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .where("a <> b").distinct(), "links"), None
    while True:
        # Large star: neighbours above u are tied to the smallest one of u's neighbourhood.
        both = state.union(state.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), F.least("a", "low").alias("m"))
        large = both.join(low, both["a"] == low["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: u and its smaller neighbours are tied to the smallest.
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        joined = large.join(low, large["a"] == low["u"])
        small = joined.select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m")),
                                                F.struct(F.col("a").alias("x"), F.col("m")))).alias("e"))
        state = written(small.select(F.col("e.x").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), "links")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = now


def near_links(distinct: DataFrame, bits: int = MAX_BITS, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at most ``bits`` apart.

    Each component of the true link graph is connected by the rows returned.
    """
    rows = distinct.count()
    share = min(1.0, sample / max(rows, 1))
    cut = int(share * (1 << 32))
    # Chosen by hash, so the same table always gives the same tree.
    chosen = [r.fp for r in distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 32)) < cut).select("fp").collect()]
    rng = np.random.default_rng(0)
    tree, leaves = grow(np.sort(np.array(chosen, np.int64).view(np.uint64)), -(-rows // leaf), rng)

    def send(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            index, leaf_, own = route(tree, fps, bits)
            yield pa.RecordBatch.from_arrays([pa.array(leaf_), pa.array(fps[index].view(np.int64)), pa.array(own)],
                                             ["leaf", "fp", "own"])

    routed = written(distinct.select("fp").mapInArrow(send, "leaf int, fp long, own boolean"), "vp_routed")
    # At most one row for each leaf of the routing tree, itself bounded by the sample.
    sizes = routed.where("own").groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(2 * leaf)).cast("int").alias("chunks"))
    # A large leaf is a grid of tasks: one chunk of its own fingerprints against one chunk of all that visit it.
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    cell = lambda a, b, own: F.struct(a.alias("chunk"), b.alias("asks"), F.lit(own).alias("own"))
    asking = lambda cells: F.transform(cells, lambda i: cell(i, F.col("mine"), False))
    owned = F.concat(F.transform(every, lambda j: cell(F.col("mine"), j, True)), asking(F.filter(every, lambda i: i != F.col("mine"))))
    dealt = (routed.join(F.broadcast(sizes), "leaf")
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
             .select("leaf", "fp", F.explode(F.when(F.col("own"), owned).otherwise(asking(every))).alias("c"))
             .select("leaf", "fp", "c.chunk", "c.asks", "c.own"))

    def compare(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        own = group.column("own").to_numpy()
        order = np.argsort(fps, kind="stable")
        fps, own = fps[order], own[order]
        labels = link(fps, own, bits, np.random.default_rng(1))
        tied = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"a": fps[tied].view(np.int64), "b": fps[labels[tied]].view(np.int64)})

    return dealt.groupBy("leaf", "chunk", "asks").applyInArrow(compare, "a long, b long")


def document_components(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS,
                        sample: int = SAMPLE, leaf: int = LEAF, row: str | None = None) -> DataFrame:
    """(doc_id, fp, root, component_id) of every row of ``docs``, and its row key if a column ``row`` holds one.

    ``root`` is a fingerprint that names the component alone; ids can repeat or be null.
    """
    keys = [F.col(row).alias("row")] if row else []
    marked = written(docs.select("doc_id", *keys, fingerprint(text_bytes(), shingle).alias("fp")), "simhash")
    names = marked.columns + ["root", "component_id"]
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "simhash_distinct")
    roots = star_components(near_links(distinct, bits, sample, leaf))
    grouped = written(distinct.join(roots, distinct["fp"] == roots["node"], "left")
                      .select("fp", "first", "copies", F.coalesce("root", "fp").alias("root")), "simhash_groups")
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(grouped.join(least, "root").select("fp", "copies", "root", "component_id"), "simhash_components")
    # At most 1000 fingerprints can hold over a thousandth of the rows each: those are
    # broadcast, so that their copies needn't meet in one task.
    total = marked.count()
    hot = named.where(F.col("copies") > F.lit(max(total // 1000, 1000))).select("fp", "root", "component_id")
    cold = marked.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(named.select("fp", "root", "component_id"), "fp")
    return cold.select(names).union(marked.join(F.broadcast(hot), "fp").select(names))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, fingerprint, component_id): fingerprint as 16 hex digits."""
    return document_components(docs, **options).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` from each component (with its smallest id), columns unchanged.

    Rows are told apart by a key of their own, so ids may repeat or be null: a component
    whose ids are all null keeps one of its rows, and one id in two components stays in both.
    """
    row = fresh(docs, "__row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "simhash_rows")
    parts = document_components(rows, row=row, **options)
    first = written(parts.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                    .groupBy("root").agg(F.min("row").alias(row)).select(row), "simhash_first")
    # Row keys are hashed, texts aren't sorted; the same join at every size, so its cost grows with the input.
    return rows.join(first.hint("shuffle_hash"), row, "left_semi").select(docs.columns)
