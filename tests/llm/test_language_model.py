"""Hashed maximum-entropy model: counts and base scores by brute force, a proper distribution, better than the base."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from taxaspark.llm import lm_maxent as L
from taxaspark.llm.common import written


def slow_tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + [None]


def test_tokens_equal_plain_python(texts):
    raw = [(t or "").encode() for t in texts]
    offsets = np.cumsum([0] + [len(t) for t in raw])
    keys, first = L.tokens(np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = [w for t in texts for w in slow_tokens(t)]
    assert len(keys) == len(want)
    assert list(np.diff(np.append(first, len(keys)))) == [len(slow_tokens(t)) for t in texts]
    # One key a word, one word a key.
    pairs = set(zip(keys.tolist(), want))
    assert len(pairs) == len({k for k, _ in pairs}) == len({w for _, w in pairs})
    # The same whatever stands around a text.
    for t in raw[:5]:
        alone, _ = L.tokens(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert set(alone.tolist()) <= set(keys.tolist())


def test_scores(docs, pdf):
    got = L.lm_scores(docs).toPandas()
    assert len(got) == len(pdf)
    name = lambda d: "" if d != d or d is None else str(int(d))
    held = [zlib.crc32(name(d).encode()) % 7 == 2 for d in pdf.doc_id]
    c = Counter(w for t, h in zip(pdf.text, held) if not h for w in slow_tokens(t))
    n, v = sum(c.values()), len(c)
    want = {}
    for d, t, h in zip(pdf.doc_id, pdf.text, held):
        w = slow_tokens(t)
        want[name(d)] = (h, len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    for r in got.itertuples():
        h, k, known, base = want[name(r.doc_id)]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, k, known, n)
        assert r.base_score == pytest.approx(base) and r.score <= 0
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum()


def test_probabilities_add_up(docs):
    """Over all classes, and over all words of a class with its unknown word."""
    model = L.train(docs)
    assert np.allclose((10.0 ** model.class_log10.astype(float)).sum(axis=1), 1, atol=1e-4)
    rows = model.counts.toPandas()
    k = rows.key.to_numpy() & (L.CLASSES - 1)
    for c in np.unique(k):
        inside = ((rows.n[k == c] - model.discount[c]) / 10 ** model.class_total[c]).sum()
        assert inside + (10 ** model.unknown[c] if c else 0) == pytest.approx(1, abs=2e-3)


def test_head_list_changes_nothing(docs, monkeypatch):
    model = L.train(docs)
    a = L.score_documents(docs, model).toPandas()
    model.head_keys, model.head_counts = model.head_keys[:0], model.head_counts[:0]
    b = L.score_documents(docs, model).toPandas()
    key = ["n_tokens", "n_known", "score"]
    assert np.allclose(a[key].sort_values(key), b[key].sort_values(key))


def test_gradient_steps_raise_the_likelihood(docs):
    events = (written(L.count_events(docs), "t").where("kind = 1")
              .selectExpr("cast(key / 128 as int) as context", "cast(key % 128 as int) as class", "n"))
    p = events.toPandas()
    fit = [(L.log_softmax(L.fit_classes(events, steps), np.arange(L.CONTEXTS))[p.context, p["class"]] * p.n).sum() for steps in (1, 8)]
    assert fit[1] > fit[0]


def after(text, model):
    """log10 of each class after the last two words of ``text``, by the table of words, and that word's key."""
    raw = np.frombuffer(text.encode(), np.uint8)
    keys, first = L.tokens(raw, np.array([0, len(raw)]))
    at, word = L.words_before(keys, first)
    context = L.contexts(keys, first)[at[-1]]
    x = model.class_log10[context].astype(float) * np.log(10)
    row = model.words.where(f"key = {word[-1:].view(np.int64)[0]}").first()
    if row:
        x[np.frombuffer(row.classes, np.uint8)] += np.frombuffer(row.weights, np.float32)
    return (x - np.log(np.exp(x).sum())) / np.log(10), int(word[-1])


def test_every_word_before_has_own_weights(spark):
    """900 words, many more than buckets, that each foretell the ending of the next one."""
    ends = ["qa", "ze", "xi", "jo", "vu", "ky"]
    # The last letters give the class; all words before end alike.
    lines = [f"start w{i}n {'b' * (j % 3)}t{ends[i % 6]} " * 4 for i in range(900) for j in range(3)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    model = L.train(df)
    assert model.words.count() == 1 + 900 + 3 * 6
    hashed = []
    for i in range(0, 900, 90):
        keys, _ = L.tokens(np.frombuffer(f"t{ends[i % 6]}".encode(), np.uint8), np.array([0, 3]))
        p, word = after(f"start w{i}n", model)
        assert 10 ** p[int(keys[0]) % L.CLASSES] > 0.6 and (10 ** p).sum() == pytest.approx(1)
        begin, _ = L.tokens(np.frombuffer(b"start", np.uint8), np.array([0, 5]))
        skip = 1 + int(begin[0] >> np.uint64(7)) % (L.SKIP - 1)
        hashed.append(10.0 ** model.class_log10[L.context_after(np.array([word], np.uint64), skip)[0], int(keys[0]) % L.CLASSES])
    assert np.mean(hashed) < 0.5  # what the buckets alone know


def test_scores_hold_the_weights_of_words(docs, texts, monkeypatch):
    """Held in memory, joined, and one by one from the table."""
    model = L.train(docs)
    key = ["doc_id", "n_tokens", "n_known", "score"]
    a = L.score_documents(docs, model).toPandas()[key].sort_values(key)
    assert len(model.word_keys) and len(model.word_keys) == model.words.count()
    model.hold_words(L.head_cut(model.words, L.F.octet_length("classes") + L.SKIP, 40 * L.CLASSES))
    assert 0 < len(model.word_keys) < model.words.count()
    b = L.score_documents(docs, model).toPandas()[key].sort_values(key)
    model.hold_words(None)
    c = L.score_documents(docs, model).toPandas()[key].sort_values(key)
    assert np.allclose(a.fillna(-1), b.fillna(-1)) and np.allclose(a.fillna(-1), c.fillna(-1))
    text = texts[0]
    words, want, counts = text.split(), 0.0, {r.key: r.n for r in model.counts.collect()}
    keys, first = L.tokens(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    for i, k in enumerate(keys):
        c = int(k) % L.CLASSES
        p = after(" ".join(words[max(0, i - 2):i]), model)[0] if i else model.class_log10[0].astype(float)
        want += p[c] + math.log10(counts[int(k.view(np.int64))] - model.discount[c]) - model.class_total[c]
    assert a[a.doc_id == 0].score.iloc[0] == pytest.approx(want, rel=1e-4)


def test_words_seen_once_keep_a_probability(spark):
    """Classes of many words seen once and none seen twice: the discount leaves each of them a count."""
    df = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(400))) for i in range(10)], "doc_id long, text string")
    model = L.train(df)
    assert (model.discount < 1).all() and np.isfinite(np.log10(1 - model.discount)).all()


def test_no_rows(no_docs):
    assert L.lm_scores(no_docs).count() == 0
    assert L.Model is not None


def test_long_words_alike_but_for_order_have_own_keys():
    """Thue-Morse words, whose polynomial hashes modulo 2**64 are equal for every odd base."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    a, b = (bytes(x) for x in ([97 + b for b in bits], [98 - b for b in bits]))
    keys, _ = L.tokens(np.frombuffer(a + b" " + b, np.uint8), np.array([0, 2 * 4096 + 1]))
    assert keys[0] >> np.uint64(7) != keys[1] >> np.uint64(7)


def test_large_types_and_long_texts(spark):
    rows = [(i, t) for i, t in enumerate(["a b c " * 20] * 6 + ["word " * 200_000, "x" * 1_000_000, " " * 1_000_000])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    small = sorted(map(tuple, L.lm_scores(df).collect()))
    assert [r[1] for r in small] == [61] * 6 + [200_001, 2, 1]
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        assert sorted(map(tuple, L.lm_scores(df).collect())) == small
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
