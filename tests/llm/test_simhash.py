"""SimHash near-duplicates against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from taxaspark.llm import simhash_vptree as S


def slow_hash(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def slow_components(fps):
    fps = np.array(fps, np.uint64)
    left, group = set(range(len(fps))), {}
    while left:
        todo, comp = [left.pop()], []
        while todo:
            i = todo.pop()
            comp.append(i)
            near = [j for j in left if bin(int(fps[i] ^ fps[j])).count("1") <= 2]
            left -= set(near)
            todo += near
        for i in comp:
            group[i] = min(comp)
    return [group[i] for i in range(len(fps))]


def test_components_equal_all_pairs(docs, pdf):
    got = S.near_duplicates(docs).toPandas()
    assert len(got) == len(pdf)
    fps = {None if d != d else int(d): slow_hash(t) for d, t in zip(pdf.doc_id, pdf.text)}
    for r in got.itertuples():
        assert int(r.fingerprint, 16) == fps[None if r.doc_id != r.doc_id else int(r.doc_id)] and len(r.fingerprint) == 16
    ids = sorted(d for d in fps if d is not None)
    want = dict(zip(ids, (ids[k] for k in slow_components([fps[d] for d in ids]))))
    named = got[got.doc_id.notna()]
    assert {int(a): int(b) for a, b in zip(named.doc_id, named.component_id)} == want


@pytest.mark.parametrize("leaf", [8, 64])
def test_links_join_all_that_all_pairs_join(spark, leaf):
    """Random, dense and chained fingerprints; far more leaves than a small table needs, and split leaves."""
    rng = np.random.default_rng(leaf)
    fps = list(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    core = int(fps[0])
    fps += [np.uint64(core ^ (1 << a) ^ (1 << b)) for a in range(0, 40, 3) for b in range(a + 1, 40, 5)]
    chain = int(fps[1])
    for k in range(0, 60, 2):
        chain ^= 3 << k
        fps.append(np.uint64(chain))
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = S.near_links(df, sample=200, leaf=leaf)
    roots = {r.node: r.root for r in S.star_components(edges).collect()}
    want = slow_components(fps)
    got = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))
    assert edges.count() < 4 * len(fps)  # a forest for each leaf task, not all pairs


def test_keep_one_of_each_group(docs):
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    named = S.near_duplicates(docs).toPandas()
    got = kept.select("doc_id").toPandas().doc_id
    assert sorted(got.dropna()) == sorted(named.component_id.dropna().unique())
    assert got.isna().sum() <= 1


def test_keep_one_with_null_and_repeated_ids(spark, words):
    """Texts without an id, and one id on several texts: one row of each component stays, whatever its id."""
    rng = np.random.default_rng(11)
    a, b, c, d, e, f = (" ".join(rng.choice(words, 40)) for _ in range(6))
    rows = [(None, a), (None, b), (None, b), (None, b.upper()),  # two components without an id
            (7, c), (7, d), (7, d),  # one id in two components
            (3, e), (None, e), (9, e), (8, f)]  # a null id beside others
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as __row", "2 as row", "3 as root").repartition(3)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.text.lower(), r.doc_id or 0, r["__row"], r.row, r.root) for r in kept.collect())
    assert got == sorted((t, i, 1, 2, 3) for t, i in [(a, 0), (b, 0), (c, 7), (d, 7), (e, 3), (f, 8)])


def test_hot_fingerprint_and_empty(spark, no_docs):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2500, "the same words here again")
                                  .otherwise(F.concat(F.lit("other "), F.repeat(F.sha1(F.col("id").cast("string")), 3))).alias("text"))
    got = S.near_duplicates(df).toPandas()
    assert len(got) == 3000 and (got[got.doc_id < 2500].component_id == 0).all()
    assert S.near_duplicates(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0
