"""The conversation trie against a plain one built from nested sequences."""

import hashlib
import random
import zlib

import pytest

from taxaspark.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, group=5, most=9):
    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, role.encode(), digest(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        rest = abs(c) % group
        built[c] = own.get(c - rest if c >= 0 else c + rest, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for seq in members:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)
    saved = {s: (len(m) - 1) * (len(s[-1][1].encode()) if s else 0) for s, m in members.items()}
    leaves, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for s in members:
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            sums[s[:d]] += saved[s]
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(s))
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids.get(s, [])), leaves[s], sums[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = ["", "hi", "yes é", "no", "long " * 50, None]
    out = []
    for c in [*range(40), -7, -5, -3, 10**12, 10**12 + 1, 2**63 - 8]:
        for t in range(rng.choice([1, 2, 3, 9, 25])):
            out.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    for c in range(100, 130):  # copies of one conversation, and ties
        out += [(c, t, "user", f"same {t}") for t in range(12)]
        out += [(c, None, "x", "null turn"), (c, 3, "assistant", "tie"), (c, 3, "assistant", "tie")]
    out += [(7, t, "user", f"deep {t % 3}") for t in range(30, 300)]  # many bands
    out += [(None, 1, "user", "no conversation")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("band, least", [(16, 100_000), (2, 100_000), (3, 7)])
def test_equals_brute_force(spark, rows, band, least, monkeypatch):
    """The same with three levels of bands and with every large group dealt out."""
    monkeypatch.setattr(T, "BLOCK", 4096 if least > 7 else 16)
    monkeypatch.setattr(T, "LINE", 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.selectExpr("*", "'x' as digest", "1 as depth", "2 as a", "3 as n")  # clashing names
    assert got(T.conversation_trie(df, band=band, least=least, least_ends=least)) == brute(rows)


def test_hot_conversation_and_hot_parent(spark):
    """One conversation holds a third of all turns, the root has all others as children, a third end at one node."""
    rows = [(0, t, "user", f"t{t}") for t in range(900)]
    rows += [(5 * c, t, "user", f"own {c} {t}") for c in range(1, 400) for t in range(2)]
    rows += [(5 * c, t, "user", "copy") for c in range(400, 800) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(T.conversation_trie(df, least=100, least_ends=100)) == brute(rows)


def test_long_texts_and_empty_tables(spark):
    rows = [(c, t, "user", "x" * 1_000_000 + str(t)) for c in (10, 15) for t in range(2)]
    assert got(T.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert T.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = spark.createDataFrame([(None, None, None, None)], SCHEMA)
    assert T.conversation_trie(nothing).collect() == []
    turn = [(3, None, None, None)]
    assert got(T.conversation_trie(spark.createDataFrame(turn, SCHEMA))) == brute(turn)


def test_an_edge_row_lists_at_most_a_band(spark, rows):
    turns, lengths = T.rebuild(T.turn_rows(spark.createDataFrame(rows, SCHEMA)))
    levels = T.F.size(T._band_rows(3, 4))
    depth = spark.range(64).withColumnRenamed("id", "depth").select("depth", levels.alias("n"))
    assert depth.agg({"n": "max"}).first()[0] <= 5
    assert turns.count() == lengths.agg({"length": "sum"}).first()[0]
