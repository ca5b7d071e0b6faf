"""License notices: phrase places and diagonals against plain Python, planted notices with edits."""

import random
import re
from collections import defaultdict

import pytest

from taxaspark.llm import license_diagonals as D

WORD = re.compile(f"[^{D.SEPARATORS}]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, temps):
    w = words(text)
    marks = []
    for _, label, phrase, t in temps:
        k = min(D.K, len(t))
        lines = defaultdict(list)
        for p in range(len(w) - k + 1):
            for q in range(len(t) - k + 1):
                if w[p:p + k] == t[q:q + k]:
                    lines[p - q].append(q)
        for d, places in lines.items():
            reach = 0 if phrase else D.GAP
            near = [(e, q) for e in range(d - reach, d + reach + 1) for q in lines.get(e, [])]
            if any((len(lines[e]), -e) > (len(places), -d) for e in range(d - reach, d + reach + 1) if e in lines):
                continue
            first, last = min(e + q for e, q in near), max(e + q + k - 1 for e, q in near)
            covered = {q + i for _, q in near for i in range(k)}
            likeness = len(covered) / max(len(t), last - first + 1)
            if likeness >= D.LEAST:
                marks.append((label, phrase, first, likeness))
    base = [m for m in marks if m[1]]
    places = [m[2] for m in base]
    return (len(w), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({m[0] for m in base})),
            ",".join(sorted({m[0] for m in marks})), max((m[3] for m in marks), default=0.0))


def got(df):
    return {r["doc_id"]: tuple(r)[1:] for r in D.license_scan(df).collect()}


@pytest.fixture(scope="module")
def noticed(words_list=None):
    rng = random.Random(7)
    vocabulary = ["the", "software", "license", "of", "rights", "all", "cc", "by", "zu", "über", "general", "public"]
    out = []
    for i, (label, text) in enumerate(D.NOTICES):
        t = text.split()
        pad = [rng.choice(vocabulary) for _ in range(20)]
        out.append(" ".join(pad + t + pad))
        out.append(" ".join(pad + t[:len(t) // 2] + ["inserted", "words"] + t[len(t) // 2:] + pad))
        out.append(" ".join(pad + t[:-len(t) // 2] + pad))
        cut = rng.randrange(len(t))
        out.append(" ".join(t[:cut] + ["changed"] + t[cut + 1:]).upper())
    out += [" ".join(rng.choice(vocabulary) for _ in range(300)) for _ in range(30)]
    out += [None, "", " ", "CC-BY", "cc by cc by", "by cc", "cc", "All rights reserved. ALL RIGHTS\nRESERVED all rights", "all ríghts reserved"]
    return out


def test_equals_brute_force(spark, noticed):
    df = spark.createDataFrame(list(enumerate(noticed)), "doc_id long, text string").repartition(4)
    df = df.selectExpr("*", "1 as rid", "2 as at", "'x' as label", "3 as w0", "true as phrase")
    temps = D.templates()
    expected = {i: brute(t, temps) for i, t in enumerate(noticed)}
    assert got(df) == expected


def test_notices_are_found_and_edited_ones_too(spark):
    rng = random.Random(2)
    rows, labels = [], {}
    for i, (label, text) in enumerate(D.NOTICES):
        t = text.split()
        rows.append((2 * i, " ".join(t)))
        labels[2 * i] = label
        if len(t) > 30:  # one word replaced and one left out
            cut = rng.randrange(8, len(t) - 8)
            rows.append((2 * i + 1, " ".join(t[:cut] + ["other"] + t[cut + 1:cut + 6] + t[cut + 7:])))
            labels[2 * i + 1] = label
    found = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(labels[i] in found[i][5].split(",") for i in labels)


def test_clean_texts_repeats_and_long_texts(spark, docs, pdf):
    temps = D.templates()
    result = D.license_scan(docs).toPandas()
    assert len(result) == len(pdf)
    assert sorted(map(str, result.doc_id)) == sorted(map(str, pdf.doc_id))
    long = {1: "word " * 1_000_000, 2: "all rights reserved " * 100_000, 3: "x" * 1_000_000, 4: " " * 1_000_000}
    found = got(spark.createDataFrame(list(long.items()), "doc_id long, text string"))
    assert found[1][:2] == (1_000_000, 0) and found[3][:2] == (1, 0) and found[4][:2] == (0, 0)
    assert found[2][:4] == (300_000, 100_000, 0, 299_997) and found[2][4:6] == ("reserved", "reserved")
    assert temps and D.license_scan(docs.limit(0)).collect() == []
    same = spark.createDataFrame([(1, "cc by"), (1, "cc by"), (None, "cc by")], "doc_id long, text string")
    assert [r.n_base for r in D.license_scan(same).collect()] == [1, 1, 1]


def test_native(spark, docs):
    plan = D.license_scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    scan = D.hits(docs, D.templates())._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in scan and "Exchange hashpartitioning" not in scan
