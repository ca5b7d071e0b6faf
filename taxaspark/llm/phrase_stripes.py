"""Phrase collocations from stripes.

A stripe is a prefix of up to three words with a counter of the words that follow it.  Tasks make the
stripes of some megabytes of text at once, each packed into two strings; stripes of one
prefix are shuffled together and their counters added element by element.  One merged structure then gives

- extensions: the counter's entries are the counts of phrases one word longer,
- prefix totals: a prefix is itself an entry, of the stripe of all its words but the last,
- subsumption maxima: the largest entry is the most frequent phrase that the prefix begins.

A part of a phrase occurs at least as often as the phrase, so stripes are made in three passes and only for
what can still reach ``least`` occurrences: words, then pairs of frequent words, then sequences of
frequent pairs.  A pass knows the frequent phrases of the one before by a bit array of fixed size, which may
let too much through (more rows travel, the counts are the same) but never too little.

The stripe of a frequent prefix is split by a hash of the next word: the words above 1/10,000 of all
are listed (so at most 10,000), and a prefix of only such words gets ``PARTS`` stripes.  The empty prefix, whose counter is
the vocabulary (and has the number of all words under the empty word), gets ``WORD_PARTS``.  A task holds the words
of ``FLUSH`` bytes of text, or of one longer document.

Defined cases: null text is empty, a null language is ``und``; repeated rows count each; an empty table
gives an empty result; other columns aren't read.  Ties in score and count go by the phrase's UTF-8 bytes,
ties between cuts to the shorter first part.  Texts of any length are read whole.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taxaspark.llm.common import join_unique, written

LEAST = 30
SUBSUMED = 80  # percent
TOP = 2000
PARTS = 256
WORD_PARTS = 1024
FLUSH = 16 << 20
#: Bits of the array of frequent phrases: 16 a phrase, within these bounds (at most 32 MB).
BITS = (1 << 20, 1 << 28)

#: ``key`` is language, tab, prefix (words hold no tab); ``next`` the words after it and ``counts`` their numbers,
#: both joined by spaces; null counts are all 1.
STRIPE = pa.schema([("key", pa.string()), ("part", pa.int32()), ("next", pa.string()), ("counts", pa.string())])
DDL = "key string, part int, next string, counts string"

#: Byte by byte: A-Z in lower case, a tab as space, the ends of pieces as 0xFF (no byte of UTF-8).
BREAK = b"\xff"
BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 0xFF if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def coded(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, int]:
    """(distinct words, the word at each place, code of the break between pieces)."""
    line = BREAK + BREAK.join(texts).translate(BYTES) + BREAK
    line = line.replace(BREAK, b" \xff ").strip(b" ")
    line = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(line)], "<i8")), pa.py_buffer(line)])
    found = pc.ascii_split_whitespace(line).values.dictionary_encode()
    words = found.dictionary.cast(pa.large_binary()).cast(pa.binary())
    return words, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.index(pa.scalar(BREAK, pa.binary())).as_py()


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of the pairs, other for other orders."""
    with np.errstate(over="ignore"):
        x = (first ^ (first >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + second
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def joined(by: bytes, *words) -> pa.Array:
    return words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, pa.scalar(by, pa.binary()))


def stripes(lang: str, prefixes: pa.Array, prefix: np.ndarray, nexts: pa.Array, counts: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    """Rows of the counters {(prefix, next): count}, dealt to ``parts``."""
    order = np.lexsort((parts, prefix))
    prefix, parts, counts = prefix[order], parts[order], counts[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(prefix) != 0) | (np.diff(parts) != 0)])
    offsets = pa.array(np.r_[starts, len(prefix)], pa.int32())
    following = pc.binary_join(pa.ListArray.from_arrays(offsets, nexts.take(pa.array(order))), b" ")
    numbers = pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()).cast(pa.string())), " ")
    ones = pa.array(np.maximum.reduceat(counts, starts) == 1)
    key = joined(b"\t", pa.scalar(lang.encode(), pa.binary()), prefixes.take(pa.array(prefix[starts])))
    return pa.RecordBatch.from_arrays([key.view(pa.string()), pa.array(parts[starts], pa.int32()), following.view(pa.string()),
                                       pc.if_else(ones, pa.scalar(None, pa.string()), numbers)], schema=STRIPE)


def text_stripes(lang: str, texts: list[bytes], size: int, bits: np.ndarray | None, hot: frozenset, parts: int):
    """Stripes of these texts: of the empty prefix (``size`` 0), of frequent words (1), or of 2 and 3 words that start
    with a frequent pair (2).  ``bits`` holds the frequent words or pairs, ``hot`` the words that make a prefix wide."""
    words, code, gap = coded(texts)
    v, real, listed = len(words), code != gap, words.to_pylist()
    hashes = word_hashes(lang, listed)
    if size == 0:
        tally = np.bincount(code[real], minlength=v)
        known = np.flatnonzero(tally)
        deal = np.r_[0, (hashes[known] % np.uint64(WORD_PARTS)).astype(np.int64)]
        nexts = pa.concat_arrays([pa.array([b""], pa.binary()), words.take(pa.array(known))])
        yield stripes(lang, pa.array([b""], pa.binary()), np.zeros(len(known) + 1, np.int64), nexts, np.r_[tally.sum(), tally[known]], deal)
        return
    wide = np.fromiter((w in hot for w in listed), bool, v)
    deal = (hashes % np.uint64(parts)).astype(np.int64)
    at = np.full(len(code), -1, np.int64)  # the prefix that starts at each place
    if size == 1:
        good = is_set(bits, hashes)
        good[gap] = False
        spelt = np.flatnonzero(good)[:, None]
        follows = good[code]  # whether the word at a place may follow a prefix
        at[follows] = (np.cumsum(good) - 1)[code[follows]]
    else:
        places = np.flatnonzero(real[:-1] & real[1:])
        pairs, which = np.unique(code[places] * v + code[places + 1], return_inverse=True)
        good = is_set(bits, mixed(hashes[pairs // v], hashes[pairs % v]))
        spelt = np.stack([pairs // v, pairs % v], 1)[good]
        kept = good[which]
        at[places[kept]] = (np.cumsum(good) - 1)[which[kept]]
        follows = np.zeros(len(code), bool)
        follows[places[kept] + 1] = True
    for size in (size,) if size == 1 else (2, 3):
        if not len(spelt):
            return
        starts = np.flatnonzero((at[:-size] >= 0) & follows[size:])
        longer, which, n = np.unique(at[starts] * v + code[starts + size], return_inverse=True, return_counts=True)
        if not len(longer):
            return
        prefix, then = longer // v, longer % v
        part = np.where(wide[spelt].all(axis=1)[prefix], deal[then], 0)
        yield stripes(lang, joined(b" ", *[words.take(pa.array(c)) for c in spelt.T]), prefix, words.take(pa.array(then)), n, part)
        at[:] = -1
        at[starts] = which
        spelt = np.concatenate([spelt[prefix], then[:, None]], 1)


def make_stripes(batches, size: int, bits: bytes | None = None, hot: frozenset = frozenset(), parts: int = PARTS, flush: int = FLUSH):
    """Arrow task: (lang, text) rows to stripes, some megabytes of text at a time."""
    bits = None if bits is None else np.frombuffer(bits, np.uint8)
    kept, held = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            kept.setdefault(lang, []).append(text)
            held += len(text)
            if held >= flush:
                for k, texts in kept.items():
                    yield from text_stripes(k, texts, size, bits, hot, parts)
                kept, held = {}, 0
    for k, texts in kept.items():
        yield from text_stripes(k, texts, size, bits, hot, parts)


def merged(stripe_rows: DataFrame, least: int) -> DataFrame:
    """(lang, prefix, next, n): counters of equal prefixes added up, entries from ``least`` on, and the empty word's.

    Only packed stripes are shuffled, by prefix and part; the counters are opened and summed where they arrive.
    """
    counter = F.arrays_zip(F.split("next", " ").alias("next"), F.coalesce(F.split("counts", " "), F.array().cast("array<string>")).alias("n"))
    entries = (stripe_rows.repartition("key", "part").select("key", "part", F.inline(counter))
               .groupBy("key", "part", "next").agg(F.sum(F.coalesce(F.col("n").cast("bigint"), F.lit(1))).alias("n"))
               .where((F.col("n") >= least) | (F.col("next") == "")))
    prefix = F.substring_index("key", "\t", -1)
    lang = F.expr("substring(key, 1, length(key) - length(substring_index(key, '\t', -1)) - 1)")
    return written(entries.select(lang.alias("lang"), prefix.alias("prefix"), "next", "n"), "phrase_stripes")


def _bit_places(batches, bits: int):
    """Places of frequent words or pairs in the bit array, from 1 as the bitmap functions count."""
    for batch in batches:
        lang, phrase = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out = np.zeros(len(lang), np.uint64)
        for i, (k, p) in enumerate(zip(lang, phrase)):
            h = word_hashes(k, p.encode().split(b" "))
            out[i] = h[0] if len(h) == 1 else mixed(h[:1], h[1:])[0]
        yield pa.RecordBatch.from_arrays([pa.array((out & np.uint64(bits - 1)).astype(np.int64) + 1)], names=["place"])


def bit_array(phrases: DataFrame) -> bytes:
    """Bits of the (lang, phrase) rows; the driver sees at most ``BITS[1]`` bits."""
    bits = min(max(1 << (16 * max(1, phrases.count()) - 1).bit_length(), BITS[0]), BITS[1])
    places = phrases.select("lang", "phrase").mapInArrow(partial(_bit_places, bits=bits), "place long")
    blocks = places.groupBy(F.bitmap_bucket_number("place").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    out, step = np.zeros(bits // 8, np.uint8), 4096  # bytes of a block of the bitmap functions
    for row in blocks.toLocalIterator():
        out[(row["block"] - 1) * step:row["block"] * step] = np.frombuffer(row["bitmap"], np.uint8)
    return out.tobytes()


def phrase_counts(docs: DataFrame, least: int = LEAST, parts: int = PARTS, flush: int = FLUSH) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n) of all words, [(lang, prefix, next, n) of words, of pairs, of longer phrases]): all with ``least`` occurrences."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    def counted(**how):
        return merged(texts.mapInArrow(partial(make_stripes, flush=flush, **how), DDL), least)

    first = counted(size=0)
    totals, words = first.where("next = ''").select("lang", "n"), first.where("next != ''")
    every = totals.agg(F.sum("n")).first()[0] or 0
    hot = frozenset(r[0].encode() for r in words.where(F.col("n") > every / 10_000).select("next").collect())
    pairs = counted(size=1, bits=bit_array(words.select("lang", F.col("next").alias("phrase"))), hot=hot, parts=parts)
    spelt = pairs.select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"))
    return totals, [words, pairs, counted(size=2, bits=bit_array(spelt), hot=hot, parts=parts)]


def cut_score() -> Column:
    """floor(2,000,000 a / (l + r)), exact beyond 64 bits."""
    return F.expr("cast(cast(2000000 * cast(a as decimal(20, 0)) as decimal(30, 0)) div (cast(l as decimal(20, 0)) + r) as bigint)")


def collocations(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP, parts: int = PARTS,
                 flush: int = FLUSH, hot_rows: int = 100_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to 4 words."""
    totals, (single, *more) = phrase_counts(docs, least, parts, flush)
    words = F.split("phrase", " ")
    found = reduce(DataFrame.unionByName, more).select("lang", "prefix", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("n").alias("a"))
    found = written(found.withColumn("size", F.size(words)), "phrases")
    known = found.where("size < 4").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")).unionByName(
        single.select("lang", F.col("next").alias("part"), F.col("n").alias("f")))

    def cut(first, n):
        return F.array_join(F.slice("w", first, n), " ")

    # Both parts of each cut get their totals.
    cuts = found.select("lang", "phrase", "a", words.alias("w"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = F.array(F.struct(F.lit(True).alias("left"), cut(F.lit(1), F.col("k")).alias("part")),
                    F.struct(F.lit(False).alias("left"), cut(F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))
    sides = written(cuts.select("lang", "phrase", "a", "k", F.inline(sides)), "phrase_cuts")
    counted = join_unique(sides, known, ["lang", "part"], hot_rows)
    scored = counted.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
                                                             F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    lowest = (scored.select("lang", "phrase", "a", F.struct(cut_score().alias("score"), "k", "l", "r").alias("cut"))
              .groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    # The most frequent longer phrase: of those that it begins, the stripe's largest entry; of the others, each names what it holds.
    begun = found.where("size > 2").groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("a").alias("longest"))
    within = F.filter(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")))),
        lambda p: p != F.col("prefix"))
    inside = found.where("size > 2").select("lang", F.explode(within).alias("phrase"), F.col("a").alias("longest"))
    longest = begun.unionByName(inside).groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    big = "decimal(20, 0)"
    dropped = 100 * F.col("longest").cast(big) >= subsumed * F.col("a").cast(big)
    kept = lowest.join(longest, ["lang", "phrase"], "left").where(~F.coalesce(dropped, F.lit(False)))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    # Languages may be many: a shuffled join with the few rows that are left of each.
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
