"""Packing: every id in one piece, windows full, ids those of the tokenizers library."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from taxaspark.llm.packing import CONTEXT, TIERS, Packer, pack_documents
from taxaspark.llm.queries import byte_bpe_added, byte_bpe_files, op2_packing


def check(pieces):
    """Gapless windows and documents; returns the padding."""
    padding = 0
    for _, w in pieces.groupby("sequence_id"):
        w = w.sort_values("offset")
        assert (w.offset == w.length.cumsum() - w.length).all()
        used = w.length.sum()
        assert used <= w.context.iloc[0] <= CONTEXT
        padding += 0 if used & (used - 1) == 0 else CONTEXT - used
    return padding


def test_pieces_hold_each_id_once(docs, pdf):
    got = pack_documents(docs, *byte_bpe_files(), with_ids=True).toPandas()
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    hf.encode_special_tokens = True
    want = sorted((-1 if d != d or d is None else int(d), tuple(hf.encode(t or "", add_special_tokens=False).ids + [1])) for d, t in zip(pdf.doc_id, pdf.text))
    padding = check(got)
    parts = docs.rdd.getNumPartitions()
    assert padding < CONTEXT * parts
    # Put the pieces together again; repeated rows have the same pieces' starts, so match by sequence order.
    have = {}
    for r in got.itertuples():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        have.setdefault(-1 if r.doc_id != r.doc_id else int(r.doc_id), []).append(r)
    for d in {w[0] for w in want}:
        ids = next(w[1] for w in want if w[0] == d)
        copies = sum(w[0] == d for w in want)
        assert sum(r.length for r in have[d]) == copies * len(ids)
        for r in have[d]:
            assert tuple(r.ids) == ids[r.start:r.start + r.length] and r.doc_tokens == len(ids)


@pytest.mark.parametrize("pack", ["query", "pipeline"])
def test_ids_equal_the_default_encoder(spark, tmp_path, pack):
    """Without any setting of the library's encoder: the added token's string is its id."""
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y  <|endoftext|>  z", "<|endoftext |> <|endoftext|", "plain words", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    if pack == "query":
        got = op2_packing(spark, str(tmp_path))
    else:
        got = corpus_pipeline.packed(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [(i, hf.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in enumerate(texts)]
    assert want[0][1] == [64, 220, 50256, 275, 1]
    whole = {}
    for r in got.collect():
        assert r.doc_tokens == len(want[r.doc_id][1])
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][1][r.start:r.start + r.length], "<u4").tobytes())
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert whole == {i: len(ids) for i, ids in want}


@pytest.mark.parametrize("seed", range(8))
def test_packer_on_random_lengths(seed):
    rng = np.random.default_rng(seed)
    lengths = [int(x) for x in (rng.integers(1, 4, 500) if seed == 0 else np.exp(rng.uniform(0, 9, 300)))]
    p, out = Packer(), []
    for i, n in enumerate(lengths):
        p.add(i, 0, n)
        if i % 97 == 0:
            p.pack()
            out += p.steps()
    p.pack()
    assert sum(p.size.values()) == sum(x[0] for row in p.open.values() for x in row)
    p.close()
    out += p.steps()
    seen = [np.zeros(n, int) for n in lengths]
    waste = 0
    for _, size, window in out:
        used = sum(x[0] for x in window)
        assert size in TIERS and used <= size
        waste += CONTEXT - used if used & (used - 1) else 0
        for n, doc, start in window:
            seen[doc][start:start + n] += 1
    assert all((s == 1).all() for s in seen) and waste < CONTEXT


def test_steps_are_balanced(docs):
    got = pack_documents(docs.coalesce(1), *byte_bpe_files()).toPandas()
    tokens = got.groupby("step_group").agg(t=("length", "sum"), c=("context", "first"))
    for _, g in tokens.groupby("c"):
        assert g.t.max() - g.t.min() <= 2 * CONTEXT


def test_no_rows(no_docs):
    assert pack_documents(no_docs, *byte_bpe_files()).count() == 0


def test_long_runs_equal_the_default_encoder(spark):
    """Runs of white space beyond what the rank file's pattern takes, and other long runs, before and after letters."""
    runs = [" ", "\n", "\t", " \t", "\r\n", "\u00a0", "x", "7", "!"]
    texts = [b + r * (n // len(r)) + a for r in runs for n in (1, 100_000, 1_000_000) for b, a in (("", ""), ("a", "b"))]
    texts.append("a <|endoftext|>" + " " * 1_000_000 + "<|endoftext|> b")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in pack_documents(df, *byte_bpe_files(), with_ids=True, added=byte_bpe_added()).toLocalIterator():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    for i, t in enumerate(texts):
        ids = [x for _, part in sorted(got[i]) for x in part]
        assert ids == hf.encode(t, add_special_tokens=False).ids + [1], repr(t[:5])
