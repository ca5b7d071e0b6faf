"""Quality rules with adaptive thresholds.

Per-document counts are taken from the whole text.  For each ratio built from
them a mergeable quantile sketch (logarithmic bins with a fixed relative error)
is kept per language and source; sketches merge upwards into languages and the
whole table.  The upper fence of a group, ``q75 + spread * max(q75 - q25, least)``,
replaces a fixed cutoff.  A group with fewer than ``min_rows`` rows takes the
fence of its language, and that of the whole table if the language is small too.
Documents are joined with the fences and filtered.

Defined cases: null text counts as empty; null language or source is a group of
its own; an empty text has 0 in every count and fails the base rule; repeated
rows are counted and judged each; an empty table gives an empty result; other
columns of the input are not read (``quality_rules``) or passed on (``keep_good``).  Texts of any length are
read whole; a ratio equal to its fence is kept.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taxaspark.llm.common import WHITE, fresh, join_checked, text_bytes, written

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
WINDOW = 5

STATS = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,n_lines:bigint,n_upper:bigint>"

#: ratio in permille -> least spread of its fence, in permille
RATIOS = {"symbols": 5, "dup_lines": 60, "repeat_words": 30, "upper": 20}
SPREAD = 6
MIN_ROWS = 200
#: bins of the sketch grow by this factor: any quantile is right to 1 %
GAMMA = 1.02


def repeated_words(words: list) -> int:
    """Words that lie in a 5-word window found twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if found[w] > 1:
            covered += i + WINDOW - max(i, end)
            end = i + WINDOW
    return covered


def count_text(text: bytes) -> tuple:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    chars = len(text.decode("utf-8", "replace"))
    return (len(words), chars - (len(text) - len(text.translate(None, WHITE))),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), len(text) - len(text.translate(None, UPPER)))


def text_stats(text: Column) -> Column:
    """Struct of the counts of a binary text column."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

    @F.arrow_udf(STATS)
    def count(texts: pa.Array) -> pa.Array:
        rows = [count_text(t.as_py()) for t in texts]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return count(text)


def base_failed(s: str = "") -> Column:
    n, rep = F.col(f"{s}n_words"), F.col(f"{s}n_repeat_words")
    return (n < 10) | (100 * rep > 20 * n)


def ratios(s: str = "") -> dict[str, Column]:
    """Ratios in permille; 0 where the divisor is 0."""
    share = lambda a, b: F.coalesce(1000.0 * F.col(s + a) / F.nullif(F.col(s + b), F.lit(0)), F.lit(0.0))
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
            "repeat_words": share("n_repeat_words", "n_words"), "upper": share("n_upper", "word_chars")}


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, ratio, bin, n): bin -1 holds zeros, bin b values up to GAMMA**b."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("value"))
                               for k, v in ratios().items()]))
    bin_ = F.when(F.col("x.value") <= 0, F.lit(-1)).otherwise(
        F.greatest(F.lit(0), F.ceil(F.log(F.col("x.value")) / F.log(F.lit(GAMMA))))).cast("int")
    return (stats.select("lang", "source", each.alias("x"))
            .select("lang", "source", F.col("x.ratio").alias("ratio"), bin_.alias("bin"))
            .groupBy("lang", "source", "ratio", "bin").agg(F.count("*").alias("n")))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merged per ``keys``: rows and one fence (permille) for each ratio."""
    w = W.partitionBy(*keys, "ratio").orderBy("bin")
    every = W.partitionBy(*keys, "ratio")
    value = F.when(F.col("bin") < 0, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), F.col("bin")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), value))
    least = F.element_at(F.create_map(*[F.lit(x) for k, v in RATIOS.items() for x in (k, float(v))]), F.col("ratio"))
    per = (sketch.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
           .withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(every))
           .groupBy(*keys, "ratio").agg(at(0.25).alias("q25"), at(0.75).alias("q75"), F.max("total").alias("rows"))
           .withColumn("fence", F.col("q75") + SPREAD * F.greatest(F.col("q75") - F.col("q25"), least)))
    return per.groupBy(*keys).agg(F.max("rows").alias("rows"), *[
        F.max(F.when(F.col("ratio") == k, F.col("fence"))).alias(f"fence_{k}") for k in RATIOS])


class Fences:
    """Fences of every level that has enough rows, from one table of sketches."""

    def __init__(self, stats: DataFrame, min_rows: int = MIN_ROWS):
        sketch = written(sketches(stats), "quality_sketches")
        cols = [f"fence_{k}" for k in RATIOS]
        # One row each for the sources and languages that are large enough.
        self.group = written(fences(sketch, ["lang", "source"]).where(F.col("rows") >= min_rows)
                             .select("lang", "source", F.struct(*cols).alias("by_group")), "quality_fences")
        self.lang = written(fences(sketch, ["lang"]).where(F.col("rows") >= min_rows)
                            .select("lang", F.struct(*cols).alias("by_lang")), "quality_fences")
        whole = fences(sketch.withColumn("one", F.lit(1)), ["one"]).select(*cols).first()
        self.whole = whole.asDict() if whole else dict.fromkeys(cols, 0.0)

    def verdict(self, df: DataFrame, stats: str, out: str) -> DataFrame:
        """``df`` with boolean ``out``: its counts (prefix ``stats``) pass base rule and fences."""
        d = join_checked(df, self.group, ["lang", "source"])
        d = join_checked(d, self.lang, ["lang"])
        good = ~base_failed(stats)
        for k, v in ratios(stats).items():
            f = f"fence_{k}"
            good = good & (v <= F.coalesce(F.col(f"by_group.{f}"), F.col(f"by_lang.{f}"), F.lit(self.whole[f])))
        return d.withColumn(out, good).drop("by_group", "by_lang")


def document_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts), written once: the texts are read one time."""
    return written(docs.select("doc_id", "lang", "source", text_stats(text_bytes()).alias("s"))
                   .select("doc_id", "lang", "source", "s.*"), "quality_stats")


def quality_rules(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row of ``docs``."""
    stats = document_stats(docs)
    return (Fences(stats, min_rows).verdict(stats, "", "kept")
            .withColumn("base_failed", base_failed()))


def keep_good(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged.

    Counts are taken a second time beside the texts instead of joining the
    verdicts back by id: that would shuffle every text.
    """
    f = Fences(document_stats(docs), min_rows)
    s, row, ok = "__stats", "__row", "__kept"
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), "lang", "source",
                    text_stats(text_bytes()).alias(s))
    return f.verdict(d, f"{s}.", ok).where(F.col(ok)).select(f"{row}.*")
