"""Hashed maximum-entropy language model.

A token's probability is that of its class given the tokens before it, times its own
inside the class.  Classes come from a word's spelling (its last letters and
punctuation), so unseen words have one too.  The class is a softmax over weights of
hashed features: the word before (n-gram), the one before that (skip), and both
together; and of a feature for each distinct word before and each class seen after it.  Inside a class a word has its discounted share of the class's
training tokens; what the discount sets free belongs to unknown words.

Training: every task counts its tokens and its (context, class) events, and Spark adds them up.
Weights are fitted on the events by gradient steps: tasks compute the gradient of
their contexts, the driver adds the parts and steps.  The number of hashed contexts, features and classes
is fixed, so these weights and gradients don't grow with the corpus.  The features of whole words before do, and so does
the vocabulary; both stay tables.  Given the hashed features, each word before is a fit of its own over at most
SKIP * CLASSES counts, so tasks make its gradient steps on them without another job.

Scoring: texts are read as byte arrays in batches.  Class scores of hashed features come from a table; counts and weights
of the most frequent words from bounded lists; all other tokens are joined with the tables.

Tokens are known by a 57-bit hash and their class in one long.

Defined cases: null text is empty, which has just the end token; repeated rows are scored (and learned) each;
without training tokens all probabilities are 1 (score 0); an empty table gives an empty result; other columns
aren't read.  Texts of any length are read whole.  Words are told apart by that hash alone: two of 10^9 distinct words
share one with a probability of a few in all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import WHITE, crc_mod, text_bytes, written

CLASSES = 128
BEFORE, SKIP, BOTH = 128, 32, 1024  # buckets of the word before, the one before that, and the pair
CONTEXTS = BEFORE * SKIP
FEATURES = 1 + BEFORE + SKIP + BOTH
STEPS = 30
RATE = 0.25
PRIOR = 1.0
WORD_STEPS = 12
#: At most this many frequent words are looked up in memory.
HEAD = 1 << 18
#: Of the words before, the most frequent are looked up in memory, with at most this many weights and sums.
HEAD_CELLS = 1 << 22
#: Pairs of a context and a class that a task fits or sums at once.
PAIRS = 1 << 20
#: Bytes of text and tokens that a task works on at once.
BATCH_BYTES = 1 << 20
FLUSH_TOKENS = 1 << 21

U64 = np.uint64


def _tables():
    low = np.arange(256, dtype=np.uint64)
    low[0x41:0x5B] += np.uint64(32)
    word = np.ones(256, bool)
    word[list(WHITE)] = False
    letter = np.zeros(256, bool)
    letter[0x30:0x3A] = letter[0x41:0x5B] = letter[0x61:0x7B] = letter[0x80:] = True
    return low + np.uint64(1), word, letter


LOW, WORD, LETTER = _tables()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


END = int(mix(np.array([1], U64))[0]) & ~(CLASSES - 1)  # class 0 holds the end token alone


def tokens(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first): keys of all tokens, texts one after the other, and where each text's begin.

    ``buffer`` holds the texts' bytes, ``offsets`` where each begins and the last ends.
    A key is a 57-bit hash of the lower-cased word, and its class in the 7 lowest bits.
    """
    docs = len(offsets) - 1
    word = WORD[buffer]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(buffer))]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[cuts], last[cuts - 1] = word[cuts], word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    if len(starts):
        place = np.arange(len(buffer)) - starts[np.cumsum(first) - 1]
        longest = int((ends - starts).max()) + 1
        # Pseudo-random factors of the places: powers of one number would cancel for some pairs of long words.
        factor = mix(np.arange(1, longest + 1).astype(U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
        values = LOW[buffer] * factor[np.clip(place, 0, longest - 1)]
        values[~word] = 0
        keys = mix(np.add.reduceat(values, starts))
        # Class: the last two letters before trailing punctuation, and whether there is any.
        marked = ~LETTER[buffer[ends]] & (ends > starts)
        a = np.maximum(ends - marked, starts)
        b = np.maximum(a - 1, starts)
        spelt = LOW[buffer[a]] * U64(517) + LOW[buffer[b]] * U64(263) + marked.astype(U64) * U64(7919)
        keys = (keys & ~U64(CLASSES - 1)) | (U64(1) + mix(spelt) % U64(CLASSES - 1))
    else:
        keys = np.zeros(0, U64)
    begin = np.searchsorted(starts, offsets[:-1])
    out = np.full(len(keys) + docs, END, U64)
    out[np.arange(len(keys)) + np.searchsorted(offsets, starts, side="right") - 1] = keys
    return out, begin + np.arange(docs)


def contexts(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Context number of each token: buckets of the two words before it, 0 where there is none."""
    h = keys >> U64(7)
    before, skip = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    before[1:] = 1 + (h[:-1] % U64(BEFORE - 1)).astype(np.int64)
    skip[2:] = 1 + (h[:-2] % U64(SKIP - 1)).astype(np.int64)
    before[first] = skip[first] = 0
    second = first + 1
    skip[second[second < len(keys)]] = 0
    return before * SKIP + skip


def words_before(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys): the tokens that have a word before them, and that word's key."""
    has = np.ones(len(keys), bool)
    has[first] = False
    at = np.flatnonzero(has)
    return at, keys[at - 1]


def context_after(word: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Context number from the key of the word before and the skip bucket."""
    return (1 + ((word >> U64(7)) % U64(BEFORE - 1)).astype(np.int64)) * SKIP + skip


def counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of values and how often each occurs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    begin = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(a)])
    return a[begin], b[begin], np.diff(np.r_[begin, len(a)])


def batches_of(batch: pa.RecordBatch, column: str = "text"):
    """(row numbers, bytes, offsets) of consecutive rows, about ``BATCH_BYTES`` at once."""
    texts = batch.column(column)
    wide = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_BYTES)))
        to = min(to, len(texts))
        yield np.arange(at, to), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def count_events(docs: DataFrame) -> DataFrame:
    """(kind, key, what, n): kind 0 counts token keys, kind 1 context * CLASSES + class, both with ``what`` 0.

    Kind 2 counts, by the key of the word before, skip bucket * CLASSES + class in ``what``.
    """

    def rows(kind: int, keys: np.ndarray, what: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.uint64).view(np.int64)),
                                           pa.array(what.astype(np.int32)), pa.array(n.astype(np.int64))], ["kind", "key", "what", "n"])

    def flushed(held: list, after: list):
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        yield rows(0, keys, np.zeros(len(keys)), n)
        yield rows(2, *counted(*(np.concatenate(x) for x in zip(*after))))

    def count(batches):
        events, held, after, size = np.zeros(CONTEXTS * CLASSES, np.int64), [], [], 0
        for batch in batches:
            for _, buffer, offsets in batches_of(batch):
                keys, first = tokens(buffer, offsets)
                classes = (keys & U64(CLASSES - 1)).astype(np.int64)
                context = contexts(keys, first)
                np.add.at(events, context * CLASSES + classes, 1)
                at, word = words_before(keys, first)
                after.append((word, (context[at] % SKIP * CLASSES + classes[at]).astype(np.int32)))
                held.append(keys)
                size += len(keys)
                if size >= FLUSH_TOKENS:
                    yield from flushed(held, after)
                    held, after, size = [], [], 0
        if held:
            yield from flushed(held, after)
        seen = np.flatnonzero(events)
        if len(seen):
            yield rows(1, seen, np.zeros(len(seen)), events[seen])

    return (docs.select(text_bytes().alias("text")).mapInArrow(count, "kind int, key long, what int, n long")
            .groupBy("kind", "key", "what").agg(F.sum("n").alias("n")))


def feature_rows(context: np.ndarray) -> np.ndarray:
    """The four features of contexts: constant, word before, skip, and the hashed pair."""
    before, skip = context // SKIP, context % SKIP
    pair = (mix(context.astype(U64) + U64(1)) % U64(BOTH)).astype(np.int64)
    return np.stack([np.zeros_like(context), 1 + before, 1 + BEFORE + skip, 1 + BEFORE + SKIP + pair], axis=1)


def log_softmax(weights: np.ndarray, context: np.ndarray) -> np.ndarray:
    x = weights[feature_rows(context)].sum(axis=1)
    x -= x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def fit_classes(events: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights (FEATURES x CLASSES) by gradient steps over (context, class, n), in units of the curvature.

    Every step is one Spark job over the same eight parts of the fixed number of contexts.
    """
    weights = np.zeros((FEATURES, CLASSES))

    def gradient(batches):
        seen = np.zeros((CONTEXTS, CLASSES))
        for b in batches:
            seen[b.column("context").to_numpy(), b.column("class").to_numpy()] += b.column("n").to_numpy()
        mine = np.flatnonzero(seen.any(axis=1))
        if len(mine):
            expected = np.exp(log_softmax(weights, mine)) * seen[mine].sum(axis=1, keepdims=True)
            up, curve = np.zeros((FEATURES, CLASSES)), np.zeros((FEATURES, CLASSES))
            for f in feature_rows(mine).T:
                np.add.at(up, f, seen[mine] - expected)
                np.add.at(curve, f, expected)
            used = np.flatnonzero(curve.any(axis=1))  # only the features of its contexts are sent
            yield pa.RecordBatch.from_arrays([pa.array([used.astype(np.int32).tobytes()]), pa.array([up[used].astype(np.float32).tobytes()]),
                                              pa.array([curve[used].astype(np.float32).tobytes()])], ["used", "up", "curve"])

    for step in range(steps):
        parts = events.mapInArrow(gradient, "used binary, up binary, curve binary").collect()
        if not parts:
            break
        up, curve = np.zeros((FEATURES, CLASSES)), np.zeros((FEATURES, CLASSES))
        for p in parts:
            used = np.frombuffer(p.used, np.int32)
            up[used] += np.frombuffer(p.up, np.float32).reshape(-1, CLASSES)
            curve[used] += np.frombuffer(p.curve, np.float32).reshape(-1, CLASSES)
        if step == 0:  # the best constant is known: the classes' shares
            weights[0] = np.log(up[0] + curve[0] + 1)
        else:  # the four features of a context step together, so each goes a fourth of the way
            penalised = np.where(np.arange(FEATURES)[:, None] > 0, weights, 0)
            weights = weights + np.clip(RATE * (up - PRIOR * penalised) / (curve + PRIOR), -0.5, 0.5)
    return weights


def crossed(at: np.ndarray, begin: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): each position i of ``at`` with all entries j of its word ``at[i]``, which has ``many`` from ``begin``."""
    times = many[at]
    i = np.repeat(np.arange(len(at)), times)
    return i, np.arange(len(i)) + np.repeat(begin[at] - (np.cumsum(times) - times), times)


def cut_at(sizes: np.ndarray, most: int = PAIRS):
    """Consecutive ranges (from, to) of a sum of ``sizes`` of about ``most`` each."""
    total, at = np.r_[0, np.cumsum(sizes)], 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield at, to
        at = to


def packed(values: np.ndarray, many: np.ndarray) -> pa.Array:
    """Binary array whose rows hold ``many`` of the values each."""
    offsets = np.r_[0, np.cumsum(many) * values.itemsize].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(many), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many in each row) of what ``packed`` made."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind), np.array([len(r) for r in rows], np.int64) // np.dtype(kind).itemsize


def log_sums(log_q: np.ndarray, context: np.ndarray, at: np.ndarray, classes: np.ndarray, weights: np.ndarray, many: np.ndarray) -> np.ndarray:
    """log of the sum over all classes of q(class | context) e**weight, for contexts after the words ``at``."""
    begin, out = np.cumsum(many) - many, np.zeros(len(at))
    for a, b in cut_at(many[at]):
        i, j = crossed(at[a:b], begin, many)
        q = np.exp(log_q[context[a:b][i], classes[j]].astype(float))
        out[a:b] = np.log(np.maximum(1 + np.bincount(i, q * np.expm1(weights[j].astype(float)), b - a), 1e-9))
    return out


def fit_words(after: DataFrame, log_q: np.ndarray, steps: int = WORD_STEPS) -> DataFrame:
    """(key, n, classes, weights) of each word before, from its counts (key, what, n).

    The weights of classes seen after a word raise the likelihood of its counts given the hashed features; classes that
    weren't have none.  Every word's fit is apart from all others, and bounded.
    """
    shared = after.sparkSession.sparkContext.broadcast(log_q.astype(np.float32))

    def fitted(word: np.ndarray, lengths: np.ndarray, packs: np.ndarray):
        f, n = np.repeat(np.arange(len(word)), lengths), (packs // (SKIP * CLASSES)).astype(float)
        skip, klass = packs // CLASSES % SKIP, packs % CLASSES
        spot, p = np.unique(f * SKIP + skip, return_inverse=True)
        entry, e = np.unique(f * CLASSES + klass, return_inverse=True)
        n_spot, n_entry = np.bincount(p, n), np.bincount(e, n)
        many = np.bincount(entry // CLASSES, minlength=len(word))
        of = spot // SKIP
        i, j = crossed(of, np.cumsum(many) - many, many)
        q = np.exp(shared.value[context_after(word[of], spot % SKIP)[i], (entry % CLASSES)[j]].astype(float))
        w = np.zeros(len(entry))
        for _ in range(steps):
            r = q * np.exp(w)[j]
            z = np.maximum(1 + np.bincount(i, r - q, len(spot)), 1e-9)
            expected = np.bincount(j, (n_spot / z)[i] * r, len(entry))
            w += np.clip((n_entry - expected - PRIOR * w) / (expected + PRIOR), -1, 1)
        total = np.bincount(f, n, len(word))
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(total.astype(np.int64)), packed((entry % CLASSES).astype(np.uint8), many),
                                           packed(w.astype(np.float32), many)], ["key", "n", "classes", "weights"])

    def fit(batches):
        for batch in batches:
            word, seen = batch.column("key").to_numpy().view(U64), batch.column("seen")
            lengths = seen.value_lengths().to_numpy().astype(np.int64)
            packs, begin = seen.flatten().to_numpy(), np.r_[0, np.cumsum(lengths)]
            for a, b in cut_at(np.minimum(lengths, SKIP) * np.minimum(lengths, CLASSES)):
                yield fitted(word[a:b], lengths[a:b], packs[begin[a]:begin[b]])

    return (after.groupBy("key").agg(F.collect_list(F.col("n") * (SKIP * CLASSES) + F.col("what")).alias("seen"))
            .mapInArrow(fit, "key long, n long, classes binary, weights binary"))


def head_cut(df: DataFrame, cells: Column, most: int) -> DataFrame | None:
    """The rows of largest ``n``, from the smallest power step of 2^(1/16) that leaves at most ``most`` cells; None if there is none."""
    step = F.floor(F.log2("n") * 16)
    bins = sorted(((r.s, r.c) for r in df.groupBy(step.alias("s")).agg(F.sum(cells).alias("c")).collect()), reverse=True)
    cut, held = None, 0
    for s, many in bins:
        if held + many > most:
            break
        cut, held = s, held + many
    return None if cut is None else df.where(step >= cut)


class Model:
    """Fixed-size part of a trained model; the vocabulary is the table ``counts``, weights after whole words are ``words``."""

    def __init__(self, counts: DataFrame, events: DataFrame, after: DataFrame):
        self.counts = counts
        klass = F.col("key").bitwiseAND(CLASSES - 1)
        per = (counts.groupBy(klass.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v"),
                                                     F.count(F.when(F.col("n") == 1, 1)).alias("n1"),
                                                     F.count(F.when(F.col("n") == 2, 1)).alias("n2")).collect())
        n, v, n1, n2 = (np.zeros(CLASSES) for _ in range(4))
        for r in per:
            n[r.k], v[r.k], n1[r.k], n2[r.k] = r.n, r.v, r.n1, r.n2
        self.total, self.types = int(n.sum()), int(v.sum())
        # Absolute discount, below 1; classes without enough evidence (no word seen twice, too) share that of all.
        shared = (n1.sum() + 1) / (n1.sum() + 2 * n2.sum() + 2)
        self.discount = np.where((n1 >= 10) & (n2 > 0), n1 / np.maximum(n1 + 2 * n2, 1), shared)
        self.discount[0] = 0.0
        # A class with tokens and no free mass, or without tokens, still has room for an unknown word.
        self.unknown = np.log10(np.where(n > 0, np.maximum(self.discount * v, 1e-3) / np.maximum(n, 1), 1.0))
        self.class_total = np.log10(np.maximum(n, 1))
        weights = fit_classes(events)
        log_q = log_softmax(weights, np.arange(CONTEXTS))
        self.class_log10 = (log_q / np.log(10)).astype(np.float32)
        self.words = written(fit_words(after, log_q), "lm_words")
        head = head_cut(counts, F.lit(1), HEAD)
        head = head.select("key", "n").toArrow() if head is not None else None
        keys = head.column("key").to_numpy().view(U64) if head else np.zeros(0, U64)
        order = np.argsort(keys)
        self.head_keys = keys[order]
        self.head_counts = (head.column("n").to_numpy() if head else np.zeros(0, np.int64))[order].astype(float)
        self.hold_words(head_cut(self.words, F.octet_length("classes") + SKIP, HEAD_CELLS))

    def hold_words(self, head: DataFrame | None) -> None:
        """Keeps these words' weights in memory, with the log10 of the sums that norm them, by skip bucket."""
        self.word_keys, self.word_codes = np.zeros(0, U64), np.zeros(0, np.int64)
        self.word_weights, self.word_sums = np.zeros(0, np.float32), np.zeros((0, SKIP), np.float32)
        if head is None:
            return
        log_q = head.sparkSession.sparkContext.broadcast(self.class_log10 * np.float32(np.log(10)))

        def sums(batches):
            for batch in batches:
                classes, many = unpacked(batch.column("classes"), np.uint8)
                weights, _ = unpacked(batch.column("weights"), np.float32)
                key = batch.column("key").to_numpy().view(U64)
                at = np.repeat(np.arange(len(key)), SKIP)
                z = log_sums(log_q.value, context_after(key[at], np.tile(np.arange(SKIP), len(key))), at, classes, weights, many)
                yield pa.RecordBatch.from_arrays([batch.column("key"), packed(classes, many), packed(weights, many),
                                                  packed((z / np.log(10)).astype(np.float32), np.full(len(key), SKIP))],
                                                 ["key", "classes", "weights", "sums"])

        rows = head.select("key", "classes", "weights").mapInArrow(sums, "key long, classes binary, weights binary, sums binary").toArrow()
        order = np.argsort(rows.column("key").to_numpy().view(U64))
        rows = rows.take(pa.array(order))
        self.word_keys = rows.column("key").to_numpy().view(U64)
        classes, many = unpacked(rows.column("classes"), np.uint8)
        # Classes of a word ascend, so the codes do.
        self.word_codes = np.repeat(np.arange(len(many)), many) * CLASSES + classes
        self.word_weights = (unpacked(rows.column("weights"), np.float32)[0] / np.log(10)).astype(np.float32)
        self.word_sums = unpacked(rows.column("sums"), np.float32)[0].reshape(-1, SKIP)

    def arrays(self):
        return (self.head_keys, self.head_counts, self.class_log10, self.discount, self.class_total,
                self.word_keys, self.word_codes, self.word_weights, self.word_sums)


def train(docs: DataFrame) -> Model:
    """A model of all texts of ``docs``."""
    both = written(count_events(docs), "lm_counts")
    events = (both.where("kind = 1").select((F.col("key") / CLASSES).cast("int").alias("context"),
                                            (F.col("key") % CLASSES).cast("int").alias("class"), "n"))
    return Model(both.where("kind = 0").select("key", "n"), written(events.repartition(8, "context"), "lm_events"),
                 both.where("kind = 2").select("key", "what", "n"))


def after_held(words: tuple, before: np.ndarray, skip: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(held, log10 factors): tokens whose word before is held, and what its weights and their norm change."""
    keys, codes, weights, sums = words
    if not len(keys):
        return np.zeros(len(before), bool), np.zeros(0)
    at = np.minimum(np.searchsorted(keys, before), len(keys) - 1)
    held = keys[at] == before
    at, code = at[held], at[held] * CLASSES + classes[held]
    spot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    return held, np.where(codes[spot] == code, weights[spot], 0).astype(float) - sums[at, skip[held]]


def after_joined(rows: DataFrame, model: Model) -> DataFrame:
    """(rid, s): the same of tokens (rid, key, what, times) whose word before isn't held; a word never seen changes nothing."""
    log_q = rows.sparkSession.sparkContext.broadcast(model.class_log10 * np.float32(np.log(10)))

    def factors(batches):
        for batch in batches:
            classes, many = unpacked(batch.column("classes"), np.uint8)
            weights, _ = unpacked(batch.column("weights"), np.float32)
            what, key = batch.column("what").to_numpy().astype(np.int64), batch.column("key").to_numpy().view(U64)
            at = np.arange(len(key))
            s = -log_sums(log_q.value, context_after(key, what // CLASSES), at, classes, weights, many)
            own = np.repeat(what % CLASSES, many) == classes
            s += np.bincount(np.repeat(at, many)[own], weights[own], len(key))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(s / np.log(10) * batch.column("times").to_numpy())], ["rid", "s"])

    return (rows.join(model.words.select("key", "classes", "weights"), "key").select("rid", "key", "what", "times", "classes", "weights")
            .mapInArrow(factors, "rid long, s double"))


def _score_heads(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of two sorts: a text's own (key null) with what is known in memory, and (rid, key, times) of its other tokens.

    Tokens whose word before isn't known in memory come as (rid, key of that word, what, times).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.arrays())

    def score(batches):
        from pyspark import TaskContext

        head, head_n, class_log10, discount, class_total, *words = shared.value
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for index, buffer, offsets in batches_of(batch):
                keys, first = tokens(buffer, offsets)
                row = np.repeat(np.arange(len(index)), np.diff(np.append(first, len(keys))))
                classes = (keys & U64(CLASSES - 1)).astype(np.int64)
                at = np.minimum(np.searchsorted(head, keys), max(len(head) - 1, 0))
                here = head[at] == keys if len(head) else np.zeros(len(keys), bool)
                n = head_n[at[here]]
                k = classes[here]
                add = lambda w, r: np.bincount(r, w, len(index)).astype(float)  # noqa: E731  (of no rows it gives integers)
                context = contexts(keys, first)
                after, before = words_before(keys, first)
                held, factor = after_held(words, before, context[after] % SKIP, classes[after])
                points = (add(class_log10[context, classes].astype(float), row) + add(factor, row[after[held]])
                          + add(np.log10(n - discount[k]) - class_total[k], row[here]))
                ids = np.arange(rid, rid + len(index))
                rid += len(index)
                rest = ~here
                none = pa.nulls(len(index), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), none, batch.column("doc_id").take(pa.array(index)), pa.array(np.bincount(row, minlength=len(index))),
                     pa.array(add(here[:].astype(float), row).astype(np.int64)), pa.array(add(np.log10(n + 1), row[here])), pa.array(points), none,
                     pa.nulls(len(index), pa.int32())], names)
                if rest.any():
                    yield others(ids, *counted(keys[rest], row[rest]))
                if not held.all():
                    # Row and what in one number, to count by.
                    what = context[after] % SKIP * CLASSES + classes[after]
                    key, both, times = counted(before[~held], (row[after] * (SKIP * CLASSES) + what)[~held])
                    yield others(ids, key, both // (SKIP * CLASSES), times, both % (SKIP * CLASSES))

    def others(ids, key, row, times, what=None):
        blank, dull = pa.nulls(len(key), pa.int64()), pa.nulls(len(key), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(key.view(np.int64)), blank, blank, blank, dull, dull, pa.array(times),
                                           pa.nulls(len(key), pa.int32()) if what is None else pa.array(what.astype(np.int32))], names)

    names = ["rid", "key", "doc_id", "n_tokens", "known", "plus_one", "points", "times", "what"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).mapInArrow(
        score, "rid long, key long, doc_id long, n_tokens long, known long, plus_one double, points double, times long, what int")


def _of_class(values: np.ndarray, key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), key.bitwiseAND(CLASSES - 1).cast("int") + 1)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``docs``, in log10."""
    marked = written(_score_heads(docs, model), "lm_marked")
    rest = marked.where("key is not null and what is null").select("rid", "key", "times").join(model.counts, "key", "left")
    known = F.col("n").isNotNull()
    inside = F.when(known, F.log10(F.col("n") - _of_class(model.discount, F.col("key"))) - _of_class(model.class_total, F.col("key")))
    times = F.col("times")
    per = rest.groupBy("rid").agg(F.sum(F.when(known, times).otherwise(0)).alias("k"), F.sum(times * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("b"),
                                  F.sum(times * inside.otherwise(_of_class(model.unknown, F.col("key")))).alias("s"))
    after = after_joined(marked.where("what is not null").select("rid", "key", "what", "times"), model)
    per = (per.unionByName(after.groupBy("rid").agg(F.sum("s").alias("s")), allowMissingColumns=True)
           .groupBy("rid").agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("s").alias("s")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    norm = float(np.log10(model.total + model.types + 1))
    texts = marked.where("key is null").drop("key", "times", "what").join(per, "rid", "left")
    score = F.col("points") + zero("s") if model.total else F.lit(0.0)
    return texts.select("doc_id", "n_tokens", (F.col("known") + zero("k")).alias("n_known"),
                        (F.col("plus_one") + zero("b") - F.col("n_tokens") * norm).alias("base_score"), score.alias("score"))


def lm_scores(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Scores of all ``docs`` by a model of those whose crc32(doc_id as text) mod ``folds`` isn't ``held``."""
    out = crc_mod("doc_id", folds) == held
    model = train(docs.where(~out))
    return score_documents(docs, model).withColumns({"held_out": out, "train_tokens": F.lit(model.total).cast("long")})
