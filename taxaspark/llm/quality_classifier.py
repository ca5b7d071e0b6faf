"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

Statistics of the whole text are standardised and mapped to random Fourier
features of a Gaussian kernel.  Every partition of the labelled rows adds up its
own normal equations; their sum fits ridge weights.  A held-aside part of the
training rows, binned by raw score, gives the isotonic (pool adjacent violators)
calibration to a probability.

Model size is fixed (``FEATURES`` weights and ``CAL_BINS`` bins), so what reaches the
driver doesn't depend on the table.  Defined cases: null text is empty, and an
empty text is scored like any other; several labels of one document are
averaged; without any usable label every score is 1 (nothing is known to be
bad); repeated rows are scored each; an empty table gives an empty result.  Texts of any length are
read whole; rows of one raw score share one calibrated score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import WHITE, crc_mod, text_bytes, written

FEATURES = 256
RIDGE = 1.0
SEED = 7
CAL_BINS = 4096
CAL_LOW, CAL_HIGH = -0.5, 1.5
THRESHOLD = 0.7

_CLASSES = 6  # lower, upper, digit, symbol, other ASCII punctuation, the rest


def _byte_classes() -> np.ndarray:
    c = np.full(256, 5, np.int64)
    c[0x21:0x7F] = 4
    c[0x30:0x3A] = 2
    c[0x41:0x5B] = 1
    c[0x61:0x7B] = 0
    for x in b"#*$%&|<>@^~_=+\\/":
        c[x] = 3
    return c


_CLASS_OF = _byte_classes()
N_STATS = 16


def text_features(text: bytes) -> list[float]:
    """Statistics of one whole text; all bounded or logarithmic."""
    words = text.split()
    n, size = len(words), max(1, len(text) - (len(text) - len(text.translate(None, WHITE))))
    kinds = np.bincount(_CLASS_OF[np.frombuffer(text.translate(None, WHITE), np.uint8)], minlength=_CLASSES) / size
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    distinct = set(words)
    runs = sum(a == b for a, b in zip(words, words[1:]))
    pairs = len(set(zip(words, words[1:], words[2:])))
    caps = sum(w.isupper() for w in words)
    marked = sum(w[-1] in b"#*$%&|!" for w in words)
    short = sum(len(w) == 1 for w in words)
    d = max(1, n)
    return [np.log1p(n), np.log1p(len(lines)), size / d / 10.0, kinds[0], kinds[1], kinds[2], kinds[3], kinds[4],
            len(distinct) / d, runs / d, pairs / max(1, n - 2), caps / d, marked / d, short / d,
            1 - len(set(lines)) / max(1, len(lines)), text.count(b"\n") / d]


def features(text: Column) -> Column:
    """Array of ``N_STATS`` statistics of a binary text column."""

    @F.arrow_udf("array<double>")
    def measure(texts: pa.Array) -> pa.Array:
        rows = [text_features(t.as_py()) for t in texts]
        flat = np.asarray(rows, np.float64).ravel()
        offsets = np.arange(0, len(flat) + 1, N_STATS, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return measure(text)


@dataclass
class Model:
    """Everything needed to score; ``weights`` is None if there was nothing to learn from."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    cal_x: np.ndarray | None = None
    cal_y: np.ndarray | None = None

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """sqrt(2/D) cos(Wx + b) of standardised rows, and a constant; W and b follow from the seed."""
        rng = np.random.default_rng(SEED)
        w = rng.normal(size=(N_STATS, FEATURES)) / np.sqrt(N_STATS)
        b = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2.0 / FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        raw = self.raw(x)
        p = np.interp(raw, self.cal_x, self.cal_y) if self.cal_x is not None else np.clip(raw, 0, 1)
        # A thousandth of the raw score keeps the order inside flat steps.
        return np.clip(0.999 * p + 0.001 * (np.clip(raw, CAL_LOW, CAL_HIGH) - CAL_LOW) / (CAL_HIGH - CAL_LOW), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _equation_sums(train: DataFrame, model: Model) -> DataFrame:
    """Sums of Z'Z and Z'y: one a partition, then at most 16; a partition without rows adds none."""
    d = FEATURES + 1

    def partial(batches):
        a, b, rows = np.zeros((d, d)), np.zeros(d), 0
        for x in batches:
            z = model.fourier(_matrix(x.column("f")))
            a += z.T @ z
            b += z.T @ x.column("y").to_numpy()
            rows += x.num_rows
        if not rows:
            return
        from pyspark import TaskContext
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 16]), pa.array([a.tobytes()]),
                                          pa.array([b.tobytes()])], ["k", "a", "b"])

    def add(batches):
        a, b, rows = np.zeros(d * d), np.zeros(d), 0
        for x in batches:
            for p, q in zip(x.column("a"), x.column("b")):
                a += np.frombuffer(p.as_py())
                b += np.frombuffer(q.as_py())
            rows += x.num_rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([a.tobytes()]), pa.array([b.tobytes()])], ["k", "a", "b"])

    kind = "k long, a binary, b binary"
    return train.select("f", "y").mapInArrow(partial, kind).repartition(16, "k").mapInArrow(add, kind)


def _normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all rows."""
    d = FEATURES + 1
    sums = _equation_sums(train, model).collect()
    return (np.sum([np.frombuffer(r.a) for r in sums], axis=0).reshape(d, d),
            np.sum([np.frombuffer(r.b) for r in sums], axis=0))


def pool_adjacent(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Isotonic fit: increasing means of neighbouring bins that minimise the squared error."""
    blocks: list[list[float]] = []  # mean, weight, bins
    for value, weight in zip(y, n):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, k = blocks.pop()
            u = blocks[-1]
            u[0] = (u[0] * u[1] + v * w) / (u[1] + w)
            u[1] += w
            u[2] += k
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit(rows: DataFrame) -> Model:
    """From rows (f: statistics, y: 0 to 1, fold: 0 fits, 1 calibrates)."""
    one = rows.where("fold = 0").select("y", *[F.col("f")[i].alias(f"f{i}") for i in range(N_STATS)])
    m = one.agg(F.count("*").alias("n"), *[g(f"f{i}").alias(f"{k}{i}") for i in range(N_STATS)
                                            for k, g in (("m", F.mean), ("s", F.stddev_pop))]).first()
    if not m["n"]:
        return Model(np.zeros(N_STATS), np.ones(N_STATS))
    model = Model(np.array([m[f"m{i}"] for i in range(N_STATS)]),
                  np.maximum([m[f"s{i}"] for i in range(N_STATS)], 1e-3))
    a, b = _normal_equations(rows.where("fold = 0"), model)
    penalty = np.eye(FEATURES + 1) * RIDGE
    penalty[-1, -1] = 1e-6
    model.weights = np.linalg.solve(a + penalty, b)
    width = (CAL_HIGH - CAL_LOW) / CAL_BINS

    def binned(batches):
        for x in batches:
            r = np.clip(model.raw(_matrix(x.column("f"))), CAL_LOW, CAL_HIGH - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(((r - CAL_LOW) / width).astype(np.int64)), x.column("y")], ["bin", "y"])

    bins = (rows.where("fold = 1").select("f", "y").mapInArrow(binned, "bin long, y double")
            .groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect())
    if bins:
        n = np.array([r.n for r in bins], float)
        model.cal_x = CAL_LOW + width * (np.array([r.bin for r in bins]) + 0.5)
        model.cal_y = pool_adjacent(np.array([r.y for r in bins]) / n, n)
    return model


def train_classifier(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                     label_col: str = "quality") -> Model:
    """Fit on the labelled rows of ``measured`` (id, f) whose fold is not 2.

    Fold is crc32(id as text) mod 4: 0 and 1 fit, 3 calibrates, 2 is never read.
    """
    fold = crc_mod(id_col, 4)
    y = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold != 2))
         .groupBy(id_col).agg(F.avg(F.col(label_col).cast("double")).alias("y")))
    rows = (measured.where(fold != 2).join(y, id_col)
            .select("f", "y", F.when(fold == 3, 1).otherwise(0).alias("fold")))
    return fit(written(rows, "quality_train"))


def scored(f: Column, model: Model) -> Column:

    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(rows)) if len(rows) else np.zeros(0))

    return score(f)


def measure_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics), written once: the texts are read one time."""
    return written(docs.select("doc_id", features(text_bytes()).alias("f")), "quality_features")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    measured = measure_documents(docs)
    model = train_classifier(measured, labels)
    return (measured.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), scored(F.col("f"), model).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              labelled_docs: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` scored at or above ``threshold``, columns unchanged.

    The model learns from ``labelled_docs`` (default ``docs``): rows that an earlier filter
    has dropped are still examples.  Scores are computed beside the texts, which are
    not shuffled.
    """
    model = train_classifier(measure_documents(docs if labelled_docs is None else labelled_docs), labels)
    row, s = "__row", "__score"
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                        scored(features(text_bytes()), model).alias(s))
            .where(F.col(s) >= threshold).select(f"{row}.*"))
