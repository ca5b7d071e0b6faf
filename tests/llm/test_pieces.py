"""Sampled segmentations: the right distribution, the same draws everywhere, lossless."""

import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from taxaspark.llm import piece_sampling as P

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return P.Vocabulary(PATH)


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def split(ids, count):
    ends = np.cumsum(count)
    return [ids[a:b].tolist() for a, b in zip(ends - count, ends)]


def segmentations(word, vocab, model):
    """Every segmentation of a word with its probability."""
    at = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if np.isfinite(vocab.weight[i])}
    found = {}
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts = [word[0]]
        for c, cut in zip(word[1:], cuts):
            parts = parts + [c] if cut else parts[:-1] + [parts[-1] + c]
        if all(p in at for p in parts):
            found[tuple(at[p] for p in parts)] = math.exp(sum(vocab.weight[at[p]] for p in parts))
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


@pytest.mark.parametrize("alpha, word", [(1.0, "hello"), (0.2, "segment"), (0.0, "ab  c")])
def test_draws_follow_the_lattice(alpha, word, model):
    v, m = P.Vocabulary(PATH, alpha), 20_000
    got = Counter(map(tuple, split(*v.sample([word] * m, np.arange(m, dtype=np.uint64)))))
    want = segmentations("▁" + word.replace(" ", "▁"), v, model)
    assert set(got) <= set(want)
    for k, p in want.items():
        assert abs(got[k] / m - p) < 5 * math.sqrt(p / m) + 1e-3


def test_lossless(vocab, model, texts):
    plain = [t or "" for t in texts] + ["▁x ▁", " lead", "trail ", "a\u0000b", "\u2581", "日本 𝔘", "\ufeff\u200b", "é" * 3000]
    ids, count = vocab.sample(plain, np.arange(len(plain), dtype=np.uint64))
    assert [t.decode() for t in vocab.decode(ids, count)] == plain
    for t, row in zip(plain, split(ids, count)):
        if "▁" not in t and "\u0000" not in t:
            assert model.decode(row) == t


def test_draws_do_not_depend_on_the_batch(vocab, texts):
    plain, seeds = [t or "" for t in texts], np.arange(len(texts), dtype=np.uint64) * np.uint64(977)
    all_at_once = split(*vocab.sample(plain, seeds))
    for i in (0, 7, 30, len(plain) - 1):
        assert split(*vocab.sample([plain[i]], seeds[i:i + 1]))[0] == all_at_once[i]


def test_rows(docs, no_docs):
    a = P.sample_pieces(docs, PATH).toPandas()
    b = P.sample_pieces(docs.repartition(7), PATH).toPandas()
    assert a.lossless.all() and (a.n_pieces == a.ids.map(len)).all() and len(a) == docs.count()
    key = lambda d: sorted((str(k), tuple(i)) for k, i in zip(d.doc_id, d.ids))
    assert key(a) == key(b)
    other = P.sample_pieces(docs, PATH, seed=1).toPandas()
    assert key(a) != key(other) and other.lossless.all()
    back = P.sample_pieces(docs, PATH).withColumn("back", P.decoded(F.col("ids"), PATH)).toPandas()
    texts = {None if r.doc_id is None else r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert all(t == texts[None if k != k else int(k)] for k, t in zip(back.doc_id, back.back))
    assert P.sample_pieces(no_docs, PATH).count() == 0


def thue_morse(n):
    """Two words whose polynomial hashes modulo 2**64 are equal for every odd base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_share_a_hash(vocab, monkeypatch):
    """Told apart by their letters: the same pieces as with a hash that never clashes, and lossless."""
    texts = [*thue_morse(2048), "one two three two", "two", "three " * 50, "", "twoo", "abab", "baba"]
    seeds = np.arange(len(texts)).astype(np.uint64)
    want = vocab.sample(texts, seeds)
    monkeypatch.setattr(P, "word_hashes", lambda chars, start, length: (length % 3).astype(np.uint64))
    got = vocab.sample(texts, seeds)
    assert all((a == b).all() for a, b in zip(got, want))
    assert vocab.decode(*got) == [t.encode() for t in texts]
