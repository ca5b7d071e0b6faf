"""Collocations: counts, cuts and subsumption against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from taxaspark.llm import phrase_stripes as S


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, least, subsumed, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        known = {p: c for p, c in count.items() if c >= least}
        ranked = []
        for p, a in known.items():
            if len(p) < 2:
                continue
            longer = [c for q, c in known.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * c >= subsumed * a for c in longer):
                continue
            score, _, l, r = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(df, **k):
    return sorted(tuple(r) for r in S.collocations(df, **k).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    common = ["the", "of", "New", "York", "über", "日本", "a", "x\x00y", "n't", "tab kept"]
    out = []
    for i in range(300):
        w = [rng.choice(common) for _ in range(rng.randint(1, 60))]
        text = "".join(x + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "; "]) for x in w)
        out.append((rng.choice(["en", "en", "de", None, "", "und"]), text))
    out += [("en", "New York Stock Exchange, the end")] * 40 + [("en", "a a a a a a a")] * 9
    out += [("en", None), ("en", ""), (None, "  "), ("fr", "...!?"), ("en", "word " * 5000)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("flush, parts, hot", [(8 << 20, 256, 100_000), (2000, 3, 5)])
def test_equals_brute_force(spark, rows, flush, parts, hot):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4).selectExpr("*", "1 as part", "'p' as prefix", "2 as n", "'k' as key")
    assert got(df, least=5, subsumed=80, top=50, parts=parts, flush=flush, hot_rows=hot) == brute(rows, 5, 80, 50)


def test_a_full_bit_array_changes_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "bit_array", lambda phrases: b"\xff" * 4096)
    df = spark.createDataFrame(rows[:150], "lang string, text string")
    assert got(df, least=5, top=50) == brute(rows[:150], 5, 80, 50)


def test_long_texts_and_empty_tables(spark):
    rows = [("en", "one two " * 300_000), ("en", "x" * 1_000_000), ("en", " " * 1_000_000), ("en", "." * 1_000_000)]
    result = got(spark.createDataFrame(rows, "lang string, text string"))
    assert {r[2] for r in result} <= {"one two one two", "two one two one"} and len(result) == 2
    assert result[0][3] >= 299_998 and result[0][6] == 600_001
    assert got(spark.createDataFrame([], "lang string, text string")) == []
    assert got(spark.createDataFrame([(None, None)], "lang string, text string")) == []


def test_exact_beyond_64_bits(spark):
    """2,000,000 times a count past 2^43 doesn't fit a long."""
    a, l, r = 9 * 10**15, 9 * 10**15 + 7, 10**16
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(S.cut_score()).first()[0] == 2_000_000 * a // (l + r)


def test_a_frequent_prefix_is_split(spark, rows):
    texts = [(t or "").encode() for _, t in rows]
    hot = frozenset({b"the", b"of"})
    bits = np.full(1 << 10, 255, np.uint8)
    parts = set()
    for batch in S.text_stripes("en", texts, 1, bits, hot, 8):
        for r in batch.to_pylist():
            assert r["part"] == 0 or r["key"] in ("en\tthe", "en\tof")
            parts.add((r["key"], r["part"]))
    assert len([p for p in parts if p[0] == "en\tthe"]) > 3
