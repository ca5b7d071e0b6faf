"""URL filter: rules first, then a ratio of two character language models.

URLs that a rule decides train two variable-order Markov models over UTF-8 bytes,
one of accepted and one of rejected URLs: every order up to ``ORDER`` is mixed into the
next longer one by Witten-Bell smoothing, whose weight follows the number of
followers a context has.  Contexts and their followers are known by 64-bit hashes and counted by Spark in a table
that grows with the URLs.  A model holds its most frequent contexts with all their followers, as many as make up
``PAIRS`` followers, in memory; the counts of all others are joined to the places that ask for them, so every context counts
whatever its frequency.  Where a longer context was never seen, the next shorter one decides, which is what makes the order vary.  So what the
driver and each task hold is bounded, and no two contexts share counts, however many there are.
A URL that no rule decides is rejected if its log-likelihood difference by length
(rejected minus accepted, per byte) is above a threshold, calibrated on ruled URLs kept out of
the counts: the cut with the best mean of both classes' accuracies.

Defined cases: a null url, or one without ``://``, has empty host and path, fits
no rule and is judged by the models as its text stands (null as ''); without
URLs of both kinds to learn from everything undecided is allowed; repeated rows are counted and
judged each; of cuts that calibrate equally well the middle one is taken, and a URL at the cut is allowed; an
empty table gives an empty result; other columns aren't read.  URLs of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import written

ORDER = 5
#: Followers of the contexts that a model holds in memory, at most; the others' counts are joined.
PAIRS = 1 << 20
#: One in so many ruled URLs (by crc32 of the URL) is kept for calibration.
HOLD_OUT = 5
BINS = 512
RANGE = 4.0  # log-likelihood differences a byte, both ways

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: list[tuple[str, str]], host_: Column, path_: Column) -> Column:
    """The longest rule (host/path) that fits; null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted({r for _, r in rules}, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = (host_ == name) | host_.endswith("." + name)
        found = F.when(fits & path_.startswith("/" + rest), F.lit(rule)).otherwise(found)
    return found


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(url number, context keys, pair keys) of every byte and of the end mark.

    Keys have one column for each order from 0 to ``ORDER``; a pair is a context with the byte after it. The start of
    a URL is a byte 0 before it, its end a byte 0 after it.
    """
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    pad = bytes(ORDER)
    flat = np.frombuffer(b"".join(pad + t + b"\0" for t in texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(lengths.sum()) + np.repeat(np.arange(1, len(texts) + 1) * ORDER, lengths)
    context, pair = np.empty((len(at), ORDER + 1), np.uint64), np.empty((len(at), ORDER + 1), np.uint64)
    h = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64)
    next_byte = flat[at]
    for k in range(ORDER + 1):
        if k:
            h = mix(h + (flat[at - k] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
        context[:, k] = h
        pair[:, k] = mix(h + (next_byte + np.uint64(257)) * np.uint64(0xA0761D6478BD642F))
    return owner, context, pair


def found(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted table; its length if it isn't there."""
    at = np.searchsorted(table, wanted)
    at[at < len(table)] = np.where(table[at[at < len(table)]] == wanted[at < len(table)], at[at < len(table)], len(table))
    return at


@dataclass
class Markov:
    """Held contexts (sorted keys) with their counts and numbers of followers, and held pairs with theirs.

    The counts have one place more, a zero for what isn't held.  ``whole``: there are no others.
    """

    contexts: np.ndarray
    total: np.ndarray
    followers: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    whole: bool = True

    def log_likelihood(self, context: np.ndarray, pair: np.ndarray, joined=None) -> np.ndarray:
        """``joined``: counts that aren't held, as arrays (row, order, total, followers, times)."""
        p = np.full(len(context), 1 / 256)
        for k in range(ORDER + 1):
            at = found(self.contexts, context[:, k])
            n, t, c = self.total[at], self.followers[at], self.times[found(self.pairs, pair[:, k])]
            if joined is not None:
                mine = joined[1] == k
                n[joined[0][mine]], t[joined[0][mine]], c[joined[0][mine]] = (v[mine] for v in joined[2:])
            p = np.where(n > 0, (c + t * p) / np.maximum(n + t, 1), p)
        return np.log(p)


def count_tables(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, context, pair, n) and (accepted, context, total, followers) of rows (url, verdict)."""

    def count(batches):
        for batch in batches:
            texts = [(u.as_py() or "").encode() for u in batch.column("url")]
            accepted = np.array([v.as_py() == "allow" for v in batch.column("verdict")])
            owner, context, pair = keys(texts)
            for kind in (True, False):
                mine = accepted[owner] == kind if len(owner) else np.zeros(0, bool)
                both, n = np.unique(np.stack([context[mine].ravel(), pair[mine].ravel()], 1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(both), kind)), pa.array(both[:, 0].view(np.int64)),
                                                  pa.array(both[:, 1].view(np.int64)), pa.array(n)], ["accepted", "context", "pair", "n"])

    counts = written(train.select("url", "verdict").mapInArrow(count, "accepted boolean, context long, pair long, n long")
                     .groupBy("accepted", "context", "pair").agg(F.sum("n").alias("n")), "url_counts")
    contexts = written(counts.groupBy("accepted", "context").agg(F.sum("n").alias("total"), F.count("*").alias("followers")), "url_contexts")
    return counts, contexts


def count_models(train: DataFrame, most: int = PAIRS) -> dict[str, Markov]:
    """Both models from rows (url, verdict), as far as they are held."""
    return held_models(*count_tables(train), most)


def held_models(counts: DataFrame, contexts: DataFrame, most: int = PAIRS) -> dict[str, Markov]:
    # The least count of a held context, in steps of powers of two: all whose followers fit together.
    step = F.floor(F.log2("total"))
    sums = contexts.groupBy("accepted", step.alias("step")).agg(F.sum("followers").alias("f")).collect()
    models = {}
    for name, kind in (("allow", True), ("block", False)):
        least, room, whole = 64, most, True
        for r in sorted((r for r in sums if r["accepted"] == kind), key=lambda r: -r["step"]):
            if r["f"] > room:
                whole = False
                break
            least, room = r["step"], room - r["f"]
        mine = contexts.where(F.col("accepted") == kind).where(step >= least)
        held = _sorted(mine.select("context", "total", "followers"), "context")
        pairs = counts.where(F.col("accepted") == kind).join(mine.select("context"), "context", "left_semi")
        pairs = _sorted(pairs.select("pair", "n"), "pair")
        models[name] = Markov(held[0], *[np.append(c, 0).astype(float) for c in held[1:]], pairs[0], np.append(pairs[1], 0).astype(float), whole)
    return models


def _sorted(rows: DataFrame, key: str) -> list[np.ndarray]:
    """Columns of a bounded table as arrays, in the order of ``key`` as an unsigned number."""
    table = rows.toArrow()
    first = table.column(key).to_numpy().view(np.uint64)
    order = np.argsort(first)
    return [first[order], *[table.column(c).to_numpy()[order] for c in rows.columns if c != key]]


def difference(url: Column, models, joined: Column | None = None) -> Column:
    """Log-likelihood of rejected minus accepted, by length, of a URL column. ``models``: a Spark broadcast of both.

    ``joined``: the counts that they don't hold, from ``unheld_counts``.
    """

    def score(urls: pa.Array, lists: pa.Array | None = None) -> pa.Array:
        texts = [(u.as_py() or "").encode() for u in urls]
        if not texts:
            return pa.array([], pa.float64())
        owner, context, pair = keys(texts)
        more = {"allow": None, "block": None}
        if lists is not None:
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            values = {f.name: lists.flatten().field(f.name).to_numpy(zero_copy_only=False) for f in lists.type.value_type}
            row = np.repeat(np.searchsorted(owner, np.arange(len(texts))), sizes) + values["place"]
            more = {k: (row, values["k"], *[values[f"{k}_{c}"] for c in ("total", "followers", "times")]) for k in more}
        m = models.value
        d = m["block"].log_likelihood(context, pair, more["block"]) - m["allow"].log_likelihood(context, pair, more["allow"])
        return pa.array(np.bincount(owner, d, len(texts)) / np.bincount(owner, minlength=len(texts)))

    if joined is None:
        @F.arrow_udf("double")
        def alone(urls: pa.Array) -> pa.Array:
            return score(urls)

        return alone(url)

    @F.arrow_udf("double")
    def both(urls: pa.Array, lists: pa.Array) -> pa.Array:
        return score(urls, lists)

    return both(url, joined)


def unheld_counts(urls: DataFrame, models, counts: DataFrame, contexts: DataFrame) -> DataFrame:
    """(rid, joined): for each URL of ``urls`` (rid, url) the counts of its contexts that a model doesn't hold.

    Every place of a URL asks for such a context and its follower by a row, which is joined with the tables of counts.
    """

    def ask(batches):
        parts = [m for m in models.value.values() if not m.whole]
        for batch in batches:
            texts = [(u.as_py() or "").encode() for u in batch.column("url")]
            if not texts:
                continue
            owner, context, pair = keys(texts)
            place = np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(texts)))[owner]
            rid = batch.column("rid").to_numpy()[owner]
            for k in range(ORDER + 1):
                mine = np.zeros(len(owner), bool)
                for m in parts:
                    mine |= found(m.contexts, context[:, k]) == len(m.contexts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[mine]), pa.array(place[mine].astype(np.int32)), pa.array(np.full(mine.sum(), k, np.int32)),
                     pa.array(context[mine, k].view(np.int64)), pa.array(pair[mine, k].view(np.int64))], ["rid", "place", "k", "context", "pair"])

    def of(kind: str, value: str, name: str) -> Column:
        here = F.col("accepted") == F.lit(kind == "allow")
        return F.sum(F.when(here, F.col(value)).otherwise(0)).cast("double").alias(f"{kind}_{name}")

    asked = urls.select("rid", "url").mapInArrow(ask, "rid long, place int, k int, context long, pair long")
    totals = contexts.groupBy("context").agg(*[of(kind, name, name) for kind in ("allow", "block") for name in ("total", "followers")])
    times = counts.groupBy("context", "pair").agg(*[of(kind, "n", "times") for kind in ("allow", "block")])
    got = asked.join(totals, "context").join(times, ["context", "pair"], "left")
    names = [f"{kind}_{name}" for kind in ("allow", "block") for name in ("total", "followers", "times")]
    return got.groupBy("rid").agg(F.collect_list(F.struct("place", "k", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])).alias("joined"))


def calibrated(held: DataFrame) -> float:
    """Cut on ``d`` with the best mean of both classes' accuracies, from at most 2 x ``BINS`` counts."""
    bin_ = F.floor((F.greatest(F.least("d", F.lit(RANGE - 1e-9)), F.lit(-RANGE)) + RANGE) * (BINS / (2 * RANGE)))
    rows = held.groupBy(bin_.alias("bin"), "verdict").count().collect()
    n = {k: np.zeros(BINS) for k in ("allow", "block")}
    for r in rows:
        n[r.verdict][r.bin] += r["count"]
    if not n["allow"].any() or not n["block"].any():
        return 0.0
    good = (np.append(0, n["allow"].cumsum()) / n["allow"].sum() + 1 - np.append(0, n["block"].cumsum()) / n["block"].sum())
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float(best[len(best) // 2] * 2 * RANGE / BINS - RANGE)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], most: int = PAIRS) -> DataFrame:
    """(page_id, host, path, rule, verdict, difference) of every row of ``pages``.

    ``rules``: (verdict, "host/path") pairs; a verdict is ``allow`` or ``block``.  ``most``: followers that a model holds
    in memory, which changes no result.
    """
    verdicts = {r: v for v, r in rules}
    named = F.create_map(*[F.lit(x) for r, v in verdicts.items() for x in (r, v)])
    d = (pages.select("page_id", F.col("url").cast("string").alias("url"))
         .withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
         .withColumn("rule", rule_for(rules, F.col("host"), F.col("path")))
         .withColumn("verdict", F.element_at(named, F.col("rule"))))
    ruled = d.where(F.col("verdict").isNotNull())
    held = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(HOLD_OUT)) == 0
    counts, contexts = count_tables(ruled.where(~held))
    models = d.sparkSession.sparkContext.broadcast(held_models(counts, contexts, most))
    both = all(len(m.contexts) or not m.whole for m in models.value.values())
    if both and not all(m.whole for m in models.value.values()):
        d = written(d.withColumn("rid", F.monotonically_increasing_id()), "url_rows")
        rest = unheld_counts(d, models, counts, contexts)
        d = written(d.join(rest, "rid", "left").withColumn("difference", difference(F.col("url"), models, F.col("joined"))).drop("joined"), "url_scores")
    else:
        d = d.withColumn("difference", difference(F.col("url"), models) if both else F.lit(float("-inf")))
    cut = calibrated(d.where(F.col("verdict").isNotNull() & held).withColumnRenamed("difference", "d")) if both else 0.0
    return (d.withColumn("verdict", F.coalesce("verdict", F.when(F.col("difference") > cut, "block").otherwise("allow")))
            .select("page_id", "host", "path", "rule", "verdict", "difference"))
