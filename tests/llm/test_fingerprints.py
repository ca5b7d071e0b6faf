"""Invertible Bloom lookup sketches against plain sets."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaspark.llm import iblt as I


@pytest.fixture(scope="module")
def result(docs):
    return I.fingerprint_documents(docs).toPandas()


def test_edited_texts_and_likeness(docs, result):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
                       I.digests(F.coalesce("text", F.lit(""))).alias("set")).toPandas()
    rows = rows.sort_values(["doc_id", "h"], na_position="first").reset_index(drop=True)
    assert len(result) == len(rows)
    have = {}
    for r in result.itertuples():
        have.setdefault(None if r.doc_id != r.doc_id else int(r.doc_id), []).append(r)
    for i in range(len(rows)):
        a, b = rows.text[i], rows.text[(i + 1) % len(rows)]
        half = len(a) // 2
        sha = hashlib.sha256((a[:len(a) - half] + b[:half]).encode()).hexdigest()
        d = rows.doc_id[i]
        found = [r for r in have[None if d != d else int(d)] if r.edited_sha256 == sha]
        x, y = set(rows.set[i]), set(rows.set[(i + 1) % len(rows)])
        want = len(x & y) / len(x | y) if x | y else 1.0
        assert any(r.n_chars == len(a) and r.near_next == pytest.approx(want) for r in found)
        assert all(0 <= r.near_edited <= 1 for r in found)


def test_equal_texts_have_equal_fingerprints(docs, result):
    m = result.merge(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).toPandas(), on="doc_id")
    assert (m.groupby("text").fingerprint.nunique() == 1).all()
    assert (m[m.near_next == 1].fingerprint != "").any() or len(m) < 2
    # Texts without a word are one empty set, all others differ.
    sets = m[m.text.str.strip(" \t\n\v\f\r") != ""].groupby("fingerprint").text.nunique()
    assert sets.median() == 1


def test_peeling_recovers_differences(spark):
    """Sets of every size, with overlaps, none, and all in common."""
    rng = np.random.default_rng(4)
    pairs = []
    for i, (n, common) in enumerate([(0, 0), (1, 0), (3, 3), (5, 2), (40, 39), (200, 100), (700, 0), (900, 899), (2500, 1200)]):
        x = [int(v) for v in rng.integers(-2**62, 2**62, 2 * n)]
        pairs.append((i, x[:n], x[:common] + x[n:2 * n - common]))
    df = spark.createDataFrame(pairs, "rid int, a array<long>, b array<long>")
    got = {}
    for r in I.differences(df, ["rid"]).collect():
        got.setdefault(r.rid, set()).add((r.found, r.n))
    counts = {r.rid: r.differing for r in I.difference_counts(df, ["rid"]).collect()}
    for i, a, b in pairs:
        want = {(k, 1) for k in set(a) - set(b)} | {(k, -1) for k in set(b) - set(a)}
        assert got.get(i, set()) == want and counts.get(i, 0) == len(want)


def test_too_small_a_sketch_is_tried_again(spark, monkeypatch):
    """One cell a table can't hold 60 digests: the sketch grows until it can."""
    monkeypatch.setattr(I, "PASSES", 1)
    df = spark.createDataFrame([(1, list(range(60)), list(range(30, 90)))], "rid int, a array<long>, b array<long>")
    cells = []
    real = I.written
    monkeypatch.setattr(I, "written", lambda d, name: cells.append(name) or real(d, name))
    assert I.difference_counts(df, ["rid"]).first().differing == 60
    assert "iblt_failed" in cells or cells.count("iblt_peeled") == 1


def test_following(spark):
    numbers = [3, 4, 9, 4000, 4001, 9000, -5]
    got = {r.bucket: r.then for r in I.following(spark.createDataFrame([(n,) for n in numbers], "bucket long"), per_task=100).collect()}
    order = sorted(numbers)
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_no_rows_and_one_row(no_docs, spark):
    assert I.fingerprint_documents(no_docs).count() == 0
    one = I.fingerprint_documents(spark.createDataFrame([(7, "some words here")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 15


def test_no_python_in_the_plan(docs):
    plan = I.fingerprint_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("kind", ["wide", "clustered", "hot id", "no ids", "copies"])
def test_next_document_whatever_the_ids(spark, kind, monkeypatch):
    """Ids at the ends of 64 bits, one outlier, a third of the rows with one id, none at all, a third one repeated row."""
    monkeypatch.setattr(I, "hot_bound", lambda n: 50)
    n = 600
    ids = {"wide": [-2**63 + 5, 2**63 - 9, *range(-5 * 10**18, 5 * 10**18, 10**19 // (n - 2))][:n],
           "clustered": [*range(n - 1), 2**62], "hot id": [7 if i % 3 == 0 else i for i in range(n)],
           "no ids": [None] * n, "copies": [7 if i % 3 == 0 else i for i in range(n)]}[kind]
    texts = ["the same copy" if kind == "copies" and i % 3 == 0 else f"text {i * 7919 % n}" for i in range(len(ids))]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5).cache()
    rows = I.with_next(df.withColumn("set", F.array(F.lit(1).cast("long"))), 20)
    got = [(r.doc_id, r.text, r.next_text) for r in rows.select("doc_id", "text", "next_text").collect()]
    # One cycle through all rows, whose ids never fall but once.
    assert len(got) == len(ids) and sorted(g[2] for g in got) == sorted(texts) == sorted(g[1] for g in got)
    at = {t: (i is not None, i or 0) for i, t in zip(ids, texts)}
    falls = [1 for _, t, u in got if at[u] < at[t]]
    assert len(falls) == (1 if len(set(ids)) > 1 else 0)
    if kind != "copies":
        then, seen, t = {t: u for _, t, u in got}, 0, got[0][1]
        while seen < len(got):
            t, seen = then[t], seen + 1
            if t == got[0][1]:
                break
        assert seen == len(got)
    part = I.places(df.withColumn("mixed", F.xxhash64("text")).select("doc_id", "mixed"), 20)
    sizes = df.withColumn("mixed", F.xxhash64("text")).groupBy(part.alias("p")).count().toPandas()["count"]
    assert sizes.max() <= 80


def test_long_texts(spark):
    rows = [(1, "w " * 500_000), (2, "x" * 1_000_000), (3, " " * 1_000_000), (4, "line\n" * 200_000)]
    got = {r.doc_id: r for r in I.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_chars for i in (1, 2, 3, 4)] == [1_000_000] * 4
