"""Sampled SentencePiece segmentations, and lossless decoding.

A text's pieces are drawn from the lattice of all its segmentations, each with
probability in proportion to the product of its pieces' weights: a forward pass sums the
weights of all ways to reach a position, a backward pass from the end draws each piece
given what follows.  Draws depend on the row's key, the place of the word and the step only, so a row gets
the same pieces wherever and whenever it is encoded.

No piece of the vocabulary holds a space after another character, so the lattice
falls apart into words (a run of spaces and what follows); forward sums are worked out once for each
distinct word of a batch, and all words of a batch are drawn at once, in arrays.

The vocabulary has ranks in place of log-probabilities (a BPE model); a piece of rank r weighs
1 / (r + 2.7) ** alpha.  A character outside the vocabulary is spelled in byte pieces.

Defined cases: null or empty text has no pieces and decodes to ''; the space mark itself, if a text holds it, is
spelled in bytes, so that decoding gives it back; repeated rows are encoded alike; an
empty table gives an empty result; other columns aren't read.  Texts and words of any length are encoded
whole (a word takes one step a character).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import per_worker

ALPHA = 1.0
SPACE = 0x2581
#: Stands for a literal space mark in a text; no code point is this large.
LITERAL = 0x110000
SLOTS = 1 << 22
#: Characters that a task encodes at once.
BATCH_CHARS = 1 << 21

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of consecutive groups of these lengths."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def word_hashes(chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each word: its letters by pseudo-random factors of their places (no powers, whose sums cancel for some words)."""
    factors = mix(np.arange(1, int(length.max()) + 1).astype(U64) * BASE) | U64(1)
    return mix(np.add.reduceat((chars.astype(U64) + U64(1)) * factors[within(length)], start))


def distinct_words(chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a word of each kind, the kind of every word), by hash and checked letter by letter.

    Words that share a hash with another one are told apart by their letters.
    """
    _, some, which = np.unique(word_hashes(chars, start, length), return_index=True, return_inverse=True)
    like = some[which]
    at = np.minimum(np.repeat(start[like], length) + within(length), len(chars) - 1)
    other = np.flatnonzero((length != length[like]) | np.logical_or.reduceat(chars != chars[at], start))
    more: dict[bytes, int] = {}
    for w in other.tolist():
        which[w] = more.setdefault(chars[start[w]:start[w] + length[w]].tobytes(), len(some) + len(more))
    if more:
        kinds, first = np.unique(which[other], return_index=True)
        some = np.concatenate([some, other[first]])
    return some, which


class Vocabulary:
    """Pieces of a SentencePiece model, with a hash table of all their prefixes."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_at = np.full(256, -1, np.int64)
        surface, weight, plain = [], np.full(size, -np.inf), []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                surface.append(bytes([int(piece[3:5], 16)]))
                self.bytes_at[surface[-1][0]] = i
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                surface.append(b"")
            else:
                surface.append(piece.replace("▁", " ").encode())
                weight[i] = -alpha * np.log(2.7 - model.get_score(i))
                plain.append((piece, i))
        self.weight = weight
        #: A character spelled in bytes weighs less than any piece.
        self.spelled = float(weight[np.isfinite(weight)].min() - 5.0)
        self.longest = max(len(p) for p, _ in plain)
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        assert not any("▁" in p.lstrip("▁") for p, _ in plain), "a piece goes over the end of a word"
        known: dict[int, int] = {}
        for piece, i in plain:
            h = 0
            for n, c in enumerate(piece, 1):
                h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                if n == len(piece):
                    known[h] = i
                else:
                    known.setdefault(h, -1)
        self.keys, self.pieces = np.zeros(SLOTS, U64), np.full(SLOTS, -2, np.int32)
        places = mix(np.array(list(known), U64)) % U64(SLOTS)
        for (h, i), at in zip(known.items(), places.astype(int)):
            while self.pieces[at] != -2:
                at = (at + 1) % SLOTS
            self.keys[at], self.pieces[at] = h, i

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash; -1: only a prefix, -2: neither."""
        at = (mix(hashes) % U64(SLOTS)).astype(np.int64)
        out = self.pieces[at]
        open_ = np.flatnonzero((out != -2) & (self.keys[at] != hashes))
        while len(open_):
            at[open_] = (at[open_] + 1) % SLOTS
            out[open_] = self.pieces[at[open_]]
            open_ = open_[(out[open_] != -2) & (self.keys[at[open_]] != hashes[open_])]
        return out

    def lattice(self, chars: np.ndarray, lengths: np.ndarray):
        """Edges into every position of consecutive words: (first edge of each node; start node, piece, running probability).

        Nodes are numbered word by word, one more than its characters each.  Piece -1 - c is character c in bytes.
        """
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(chars))  # characters to the end of the word
        node = np.arange(len(chars)) + np.repeat(np.arange(len(lengths)), lengths)
        active, h = np.arange(len(chars)), np.zeros(len(chars), U64)
        code = chars.astype(U64) + U64(1)
        tails, heads, pieces = [], [], []
        for n in range(1, self.longest + 1):
            h = h * BASE + code[active + n - 1]
            piece = self.find(h)
            hit = piece >= 0
            if n == 1:
                bare = active[~hit]
                tails.append(node[bare]), heads.append(node[bare] + 1), pieces.append(-1 - chars[bare].astype(np.int64))
            tails.append(node[active[hit]]), heads.append(node[active[hit]] + n), pieces.append(piece[hit].astype(np.int64))
            go = (piece != -2) & (left[active] > n)
            active, h = active[go], h[go]
        tail, head, piece = np.concatenate(tails), np.concatenate(heads), np.concatenate(pieces)
        gain = np.where(piece >= 0, self.weight[np.maximum(piece, 0)], self.spelled)
        # Forward sums, all words at once: nodes (and the edges into them) by how far from their word's start they are.
        first_node = np.cumsum(lengths + 1) - lengths - 1
        depth = within(lengths + 1)
        by_depth = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 1 << 16 else depth, kind="stable")
        rank = np.empty(len(depth), np.int32)
        rank[by_depth] = np.arange(len(depth), dtype=np.int32)
        into = rank[head]
        order = np.argsort(into.astype(np.int64) * 256 + (head - tail))  # the edges of a node by piece length
        tail, piece, gain, into = tail[order], piece[order], gain[order], into[order]
        begin = np.searchsorted(into, np.arange(len(depth) + 1, dtype=np.int32))
        total = np.full(len(depth), -np.inf)
        total[first_node] = 0.0
        share = np.empty(len(tail))
        levels = np.searchsorted(depth[by_depth], np.arange(1, int(depth.max()) + 2))
        for a, b in zip(levels[:-1], levels[1:]):  # ranks of the nodes at one depth
            group = begin[a:b] - begin[a]
            size = np.diff(begin[a:b + 1])
            x = total[tail[begin[a]:begin[b]]] + gain[begin[a]:begin[b]]
            top = np.maximum.reduceat(x, group)
            e = np.exp(x - np.repeat(top, size))
            s = np.add.reduceat(e, group)
            total[by_depth[a:b]] = top + np.log(s)
            share[begin[a]:begin[b]] = e / np.repeat(s, size)
        # Running probabilities of each node by itself, so that they don't depend on the batch.
        at, size = begin[:-1], np.diff(begin)
        run = share.copy()
        for k in range(1, int(size.max())):
            more = at[size > k] + k
            run[more] += run[more - 1]
        run[(at + size - 1)[size > 0]] = 2.0  # the last edge takes what rounding leaves
        return begin[rank], tail, piece, run

    def sample(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count of each text): sampled pieces of all texts, one after the other."""
        joined = "".join(" " + t if t else "" for t in texts)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.array([len(t) + bool(t) for t in texts], np.int64)
        if not len(chars):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        chars[chars == SPACE] = LITERAL
        chars[chars == 0x20] = SPACE
        begins = (np.cumsum(size) - size)[size > 0]
        space = chars == SPACE
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[begins] = True
        start = np.flatnonzero(head)
        length = np.diff(np.append(start, len(chars)))
        row = np.repeat(np.arange(len(texts)), size)[start]
        some, which = distinct_words(chars, start, length)
        n = length[some]
        begin, tail, piece, run = self.lattice(chars[np.repeat(start[some], n) + within(n)], n)
        origin = (np.cumsum(n + 1) - n - 1)[which]
        # Draw backwards from the end of every word until all are at their start.
        place = np.arange(len(start)) - np.searchsorted(row, row)
        seed = mix(seeds[row].astype(U64) + mix(place.astype(U64) + U64(1)))
        at, who, step = origin + length, np.arange(len(start)), 0
        drawn, owner, count = [], [], np.zeros(len(start), np.int64)
        while len(who):
            u = (mix(seed[who] + U64((step + 1) * int(BASE) % (1 << 64))) >> U64(11)).astype(np.float64) * 2.0 ** -53
            edge = begin[at]
            miss = np.flatnonzero(run[edge] <= u)
            while len(miss):
                edge[miss] += 1
                miss = miss[run[edge[miss]] <= u[miss]]
            drawn.append(piece[edge]), owner.append(who)
            count[who] += 1
            at = tail[edge]
            go = at > origin[who]
            who, at, step = who[go], at[go], step + 1
        last = np.cumsum(count) - 1
        ids = np.empty(count.sum(), np.int64)
        for k, (p, w) in enumerate(zip(drawn, owner)):
            ids[last[w] - k] = p
        return self.spell(ids, np.repeat(row, count), len(texts))

    def spell(self, ids: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces in place of -1 - c; and how many ids each row has."""
        code = np.where(ids < 0, -1 - ids, 0)
        code[code == LITERAL] = SPACE
        width = np.where(ids >= 0, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        out, code, wide, k = (np.repeat(x, width) for x in (ids, code, width, np.zeros_like(ids)))
        k = within(width)
        shift = 6 * (wide - 1 - k)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[wide]
        byte = np.where(k > 0, 0x80 | ((code >> shift) & 0x3F), np.where(wide == 1, code, lead | (code >> shift)))
        spelt = out < 0
        out[spelt] = self.bytes_at[byte[spelt]]
        return out, np.bincount(np.repeat(row, width), minlength=rows)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """UTF-8 texts of consecutive id sequences; the space put before each text is taken off."""
        n = self.lengths[ids]
        data = self.surface[np.repeat(self.starts[ids], n) + within(n)].tobytes() if len(ids) else b""
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(count))]
        return [data[a + 1:b] if b > a else b"" for a, b in zip(ends[:-1], ends[1:])]


def vocabulary(path: str, alpha: float) -> Vocabulary:
    return per_worker(("pieces", path, alpha), lambda: Vocabulary(path, alpha))


def sample_pieces(docs: DataFrame, model_path: str, key: str = "doc_id", seed: int = 0, alpha: float = ALPHA) -> DataFrame:
    """(key, ids, n_pieces, lossless) of every row: sampled piece ids, and whether decoding gave the text back."""

    def encode(batches):
        v = vocabulary(model_path, alpha)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            seeds = batch.column("seed").to_numpy().view(U64)
            ends, at = np.cumsum([len(t) + 1 for t in texts]), 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_CHARS)))
                ids, count = v.sample(texts[at:to], seeds[at:to])
                same = [a == b.encode() for a, b in zip(v.decode(ids, count), texts[at:to])]
                offsets = np.append(0, np.cumsum(count)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, len(same)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                     pa.array(count), pa.array(same)], [key, "ids", "n_pieces", "lossless"])
                at += len(same)

    rows = docs.select(F.col(key).alias("key"), "text", F.xxhash64(key, F.lit(seed)).alias("seed"))
    return rows.mapInArrow(encode, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>, n_pieces long, lossless boolean")


def decoded(ids: Column, model_path: str) -> Column:
    """Text of a column of piece ids."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        v = vocabulary(model_path, ALPHA)
        count = np.array([len(r) if r.is_valid else 0 for r in rows], np.int64)
        return pa.array([t.decode("utf-8", "replace") for t in v.decode(rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64), count)], pa.string())

    return decode(ids)
