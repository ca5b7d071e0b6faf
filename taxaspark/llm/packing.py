"""Hierarchical packing of token sequences into windows of several lengths.

Windows are powers of two from ``TIERS[0]`` to the context length.  A document
of more than a context gives whole windows of its own; its rest, like a short
document, is routed to the shortest tier that holds it.  Tiers are packed from
the longest down: each piece opens a window of its tier, whose gap is filled by
the largest pieces of shorter tiers that fit, and closed by cutting one piece.
A window is emitted when it is exactly full, so padding is left only in the last
window of a task (under one context a task).  Full windows of a tier are dealt
to step groups of equal token count, the dearest first and in snake order, so
that the attention cost of steps is balanced too.

Each task of the scan packs its own rows in chunks of bounded tokens, open
pieces going on to the next chunk: nothing is shuffled, memory does not grow with
the partition, and a lost task is packed again alone.

Defined cases: null text is an empty one, which has just the end id; repeated
rows are packed each; pieces of equal length are taken in the order they came; an empty table gives no
pieces; other columns aren't read.  A text of any length is encoded whole, in the memory of one task, and cut into windows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import byte_bpe

CONTEXT = 2048
TIERS = (128, 256, 512, 1024, 2048)
END = 1
#: Tokens held by a task at once.
CHUNK_TOKENS = 1 << 20
#: Tokens of a training step group.
STEP_TOKENS = 1 << 16

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
         "offset long, context int, step_group long")


class Packer:
    """Packs pieces (length, document, start) of one task; ``full`` collects closed windows."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.context = tiers, tiers[-1]
        self.open: dict[int, list] = {t: [] for t in tiers}  # per tier, ascending by length
        self.size = dict.fromkeys(tiers, 0)  # tokens open in each tier
        self.full: list[tuple[int, list]] = []  # (window length, pieces)

    def add(self, doc: int, start: int, length: int) -> None:
        """Whole contexts go out as they are, the rest is routed to its tier."""
        while length >= self.context:
            self.full.append((self.context, [(self.context, doc, start)]))
            start, length = start + self.context, length - self.context
        if length:
            t = self.tier(length)
            insort(self.open[t], (length, doc, start))
            self.size[t] += length

    def tier(self, length: int) -> int:
        return next(t for t in self.tiers if length <= t)

    def take(self, gap: int, below: int):
        """The largest open piece of at most ``gap`` tokens in tiers up to ``below``."""
        for t in reversed(self.tiers):
            row = self.open[t]
            if t <= below and row and row[0][0] <= gap:
                piece = row.pop(bisect_right(row, gap, key=lambda p: p[0]) - 1)
                self.size[t] -= piece[0]
                return piece
        return None

    def cut(self, gap: int, below: int):
        """The first ``gap`` tokens of the largest open piece; its rest is routed again."""
        for t in reversed(self.tiers):
            if t <= below and self.open[t]:
                length, doc, start = self.open[t].pop()
                self.size[t] -= length
                self.add(doc, start + gap, length - gap)
                return gap, doc, start
        return None

    def pack(self) -> None:
        """Close every window that the open pieces can fill; the others stay open."""
        for t in reversed(self.tiers):
            shorter = self.tiers[max(0, self.tiers.index(t) - 1)]
            while self.open[t] and sum(self.size[u] for u in self.tiers if u <= t) >= t:
                window = [self.open[t].pop()]
                self.size[t] -= window[0][0]
                gap = t - window[0][0]
                while gap:  # shorter tiers first; the own tier is cut only if they are empty
                    window.append(self.take(gap, shorter) or self.cut(gap, shorter)
                                  or self.take(gap, t) or self.cut(gap, t))
                    gap -= window[-1][0]
                self.full.append((t, window))

    def close(self) -> None:
        """What is open at the end: windows of powers of two, and one padded one for the rest."""
        rest = sorted(p for row in self.open.values() for p in row)
        self.open = {t: [] for t in self.tiers}
        left = sum(p[0] for p in rest)
        while left:
            size = next((t for t in reversed(self.tiers) if t <= left), None)
            window, gap = [], size or left
            while gap:
                length, doc, start = rest.pop()
                if length > gap:
                    rest.append((length - gap, doc, start + gap))
                    length = gap
                window.append((length, doc, start))
                gap -= length
            self.full.append((size or self.context, window))
            left -= size or left

    def steps(self) -> list[tuple[int, int, list]]:
        """Closed windows as (step in this round, window length, pieces); forgets them."""
        out, step = [], 0
        for t in self.tiers:
            windows = sorted((w for size, w in self.full if size == t), key=lambda w: -sum(p[0] ** 2 for p in w))
            groups = -(-len(windows) * t // STEP_TOKENS)
            for i, w in enumerate(windows):
                turn, at = divmod(i, groups)
                out.append((step + (at if turn % 2 == 0 else groups - 1 - at), t, w))
            step += groups
        self.full = []
        return out


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False,
                   added: dict[str, int] | None = None, json_path: str | None = None) -> DataFrame:
    """Pieces of every document: columns of ``PIECE``, and the ids themselves if asked for.

    ``sequence_id`` and ``step_group`` hold the task in their upper bits; ``added`` are the
    vocabulary's added tokens, whose strings are ordinary text without it; see ``common.byte_bpe``.
    """
    names = [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * with_ids

    def pack(batches):
        from pyspark import TaskContext

        encode, task = byte_bpe(ranks_path, pattern, added, json_path), TaskContext.get().partitionId() << 40
        packer, tokens, held, sequence, step = Packer(), [], 0, 0, 0  # tokens: (doc_id, ids)

        def rows():
            nonlocal sequence, step
            done = packer.steps()
            out = []
            for at, size, window in done:
                offset = 0
                for length, doc, start in window:
                    doc_id, ids = tokens[doc]
                    part = ids[start:start + length]
                    out.append((doc_id, start, length, zlib.crc32(part.tobytes()), len(ids), task + sequence, offset,
                                size, task + step + at) + ((part,) if with_ids else ()))
                    offset += length
                sequence += 1
            step += max((s[0] for s in done), default=-1) + 1
            columns = list(zip(*out)) or [()] * len(names)
            kinds = [pa.int32() if n == "context" else pa.list_(pa.int64()) if n == "ids" else pa.int64() for n in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        def settle():
            """Keep only the documents that open pieces still point to."""
            nonlocal tokens, held
            used = {doc: n for n, doc in enumerate(sorted({p[1] for row in packer.open.values() for p in row}))}
            packer.open = {t: [(n, used[d], s) for n, d, s in row] for t, row in packer.open.items()}
            tokens = [tokens[d] for d in used]
            held = 0

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), END).astype("<u4")
                tokens.append((doc_id, ids))
                packer.add(len(tokens) - 1, 0, len(ids))
                held += len(ids)
                if held >= CHUNK_TOKENS:
                    packer.pack()
                    yield rows()
                    settle()
        packer.pack()
        packer.close()
        yield rows()

    kind = PIECE + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, kind)
