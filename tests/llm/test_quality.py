"""Quality rules and classifier against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaspark.llm import quality_classifier as C
from taxaspark.llm import quality_rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_plain_python(docs, pdf):
    got = R.quality_rules(docs, min_rows=5).toPandas()
    assert len(got) == len(pdf)
    want = Counter((*slow_counts(t),) for t in pdf.text)
    assert Counter(zip(got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words)) == want
    failed = (got.n_words < 10) | (100 * got.n_repeat_words > 20 * got.n_words)
    assert (failed == got.base_failed).all()
    assert not (got.kept & got.base_failed).any()


def test_fences_equal_sorted_quantiles(spark):
    rng = np.random.default_rng(1)
    rows = [("en" if i % 3 else "de", f"s{i % 2}", int(x)) for i, x in enumerate(rng.integers(0, 400, 3000))]
    df = spark.createDataFrame(rows, "lang string, source string, n_symbols long").withColumn("word_chars", F.lit(1000))
    for c in ("n_dup_lines", "n_lines", "n_repeat_words", "n_words", "n_upper"):
        df = df.withColumn(c, F.lit(0))
    got = {(r.lang, r.source): r.fence_symbols for r in R.fences(R.sketches(df), ["lang", "source"]).collect()}
    for key, fence in got.items():
        v = sorted(x for lang, source, x in rows if (lang, source) == key)
        q25, q75 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
        assert fence == pytest.approx(q75 + R.SPREAD * max(q75 - q25, 5), rel=0.09)


def test_merged_sketches_are_those_of_all_rows(docs):
    s = R.sketches(R.document_stats(docs))
    whole = {(r.ratio, r.bin): r.n for r in s.groupBy("ratio", "bin").agg(F.sum("n").alias("n")).collect()}
    one = R.sketches(R.document_stats(docs).withColumn("lang", F.lit("x")).withColumn("source", F.lit("x")))
    assert whole == {(r.ratio, r.bin): r.n for r in one.collect()}


def test_odd_text_is_dropped_by_its_group(spark):
    clean = [(i, " ".join(f"w{i}x{k}" for k in range(40)), "en", "s") for i in range(60)]
    odd = [(100, " ".join(f"w{k}***" for k in range(40)), "en", "s"), (101, " ".join(f"THE{k}AND" for k in range(40)), "en", "s")]
    df = spark.createDataFrame(clean + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in R.keep_good(df, min_rows=20).collect()}
    assert kept == {i for i, *_ in clean}


def test_rules_keep_columns_and_empty_table(docs, no_docs):
    assert R.keep_good(docs).columns == docs.columns
    assert R.quality_rules(no_docs).count() == 0
    assert R.keep_good(no_docs).count() == 0


def labelled(spark, n=600):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(300)]
    good = [" ".join(rng.choice(words, 60)) for _ in range(n)]
    rows = [(i, t if i % 3 else " ".join(w + "$$$" for w in t.split()), 1 if i % 3 else 0) for i, t in enumerate(good)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_classifier_learns_and_holds_out(spark, docs):
    df = labelled(spark)
    got = C.quality_scores(df, df.select("doc_id", "quality", F.lit(0).alias("fp"))).join(df, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.97
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    # Held-out labels are never read: turning them round changes nothing.
    turned = df.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2,
                                             1 - F.col("quality")).otherwise(F.col("quality")))
    again = C.quality_scores(df, turned).toPandas()
    assert dict(zip(again.doc_id, again.score)) == pytest.approx(dict(zip(got.doc_id, got.score)))


def test_normal_equations_equal_one_matrix(spark):
    df = labelled(spark, 200)
    rows = C.measure_documents(df).join(df, "doc_id").select("f", F.col("quality").cast("double").alias("y"), F.lit(0).alias("fold"))
    model = C.fit(rows)
    p = rows.toPandas()
    z = model.fourier(np.array(p.f.tolist()))
    a, b = C._normal_equations(rows, model)
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ p.y)


def test_partitions_without_rows_send_no_sums(spark, monkeypatch):
    """However many partitions there are, the driver gets 16 sums at most."""
    rng = np.random.default_rng(2)
    rows = [([float(v) for v in rng.normal(size=C.N_STATS)], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "f array<double>, y double").repartition(40)
    deal = type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, n, *keys: deal(self, 64 if keys else n, *keys))
    model = C.Model(np.zeros(C.N_STATS), np.ones(C.N_STATS))
    assert 0 < C._equation_sums(df, model).count() <= 16
    assert C._equation_sums(df.where("y < 0"), model).count() == 0


def test_isotonic_fit_equals_brute_force():
    rng = np.random.default_rng(0)
    y, n = rng.random(40), rng.integers(1, 9, 40).astype(float)
    got = C.pool_adjacent(y, n)
    # min-max formula of isotonic regression
    mean = lambda i, j: (y[i:j + 1] * n[i:j + 1]).sum() / n[i:j + 1].sum()
    want = [max(min(mean(i, j) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    assert np.allclose(got, want)


def test_classifier_without_labels_and_rows(docs, no_docs, spark):
    labels = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    got = C.quality_scores(docs, labels).toPandas()
    assert len(got) == docs.count() and (got.score == 1).all()
    assert C.quality_scores(no_docs, labels).count() == 0
    assert C.keep_good(docs, labels).columns == docs.columns
    one = spark.createDataFrame([(i, 1) for i in range(30)] * 2, "doc_id long, quality int")
    assert C.quality_scores(docs, one).where("score is null or isnan(score)").count() == 0
