"""The analytical queries over staged tables, as DataFrame → DataFrame functions.

Every top-k has a unique tie-break after the ranking column so the result is
deterministic.  Sample-list parameters accept either a Python list (pushed to
the Parquet scan as ``IN``) or a DataFrame with a ``sample_id`` column (a
semi join).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions.columns import gt_not_nan, ordered_string_agg
from taxaspark.operators.aggregates import count_if, value_stats
from taxaspark.operators.companions import with_names
from taxaspark.operators.joins import join_sample_map, semi_join_keys
from taxaspark.operators.pivot import pivot_wide
from taxaspark.operators.sampling import sample_keys, sample_rows

SampleSet = Iterable[str] | DataFrame

# Largest id list that is pushed down as ``IN`` (and fetched to the driver in Q12); longer
# ones are semi joined, with the same result.
MAX_ID_LIST = 10_000

KINGDOM_ANY = "k__%"        # matches every lineage that starts at a kingdom
KINGDOM_DEEPER = "k__%|%"   # lineages below kingdom level


def nan_low(c: str, ascending: bool = True) -> list[Column]:
    """Sort keys that place NaN just above NULL (NULL first ascending, last descending)."""
    col = F.col(c)
    key = F.when(F.isnan(col), F.lit(None)).otherwise(col)
    if ascending:
        return [key.asc_nulls_first(), F.isnan(col).asc()]
    return [key.desc_nulls_last(), F.isnan(col).desc()]


def restrict_samples(df: DataFrame, samples: SampleSet | None) -> DataFrame:
    """Rows of the chosen samples.

    A short list becomes ``IN`` (pushed to the Parquet scan); a list longer
    than ``MAX_ID_LIST`` or a DataFrame of ids becomes a semi join.
    """
    if samples is None:
        return df
    if isinstance(samples, DataFrame):
        return semi_join_keys(df, samples)
    ids = list(samples)
    if len(ids) > MAX_ID_LIST:
        keys = df.sparkSession.createDataFrame([(i,) for i in ids], "sample_id string")
        return semi_join_keys(df, keys)
    return df.where(F.col("sample_id").isin(ids))


# Q1 ------------------------------------------------------------------------

def sample_rows_for(stg: DataFrame, sample_id: str, limit: int | None = None) -> DataFrame:
    """All rows of one sample (point lookup on the clustered key)."""
    df = stg.where(F.col("sample_id") == sample_id)
    return df.limit(limit) if limit else df


# Q2 / Q2b ------------------------------------------------------------------

def _marker_stats(abundance: DataFrame, approx_rsd: float | None, counts: DataFrame | None) -> DataFrame:
    """Statistics of each marker; its samples are counted, estimated, or taken from ``counts`` (marker_id, sample_count)."""
    if counts is None:
        return value_stats(abundance, "marker_id", "abundance", prefix="abundance", approx_rsd=approx_rsd)
    return value_stats(abundance, "marker_id", "abundance", prefix="abundance", count=False).join(
        counts.withColumnRenamed("marker_id", "counted"), F.col("marker_id").eqNullSafe(F.col("counted"))).drop("counted")


def top_markers_by_mean(abundance: DataFrame, k: int = 20, digits: int | None = 6,
                        approx_rsd: float | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Markers ranked by mean abundance: sample count, mean, max, min.

    Ranked on the exact mean; ``digits`` only rounds the reported value.
    ``approx_rsd`` makes ``sample_count`` an HLL estimate (cheaper at scale); ``counts`` are exact ones
    kept as bitmaps (``companions.sample_counts``), which leaves one level of aggregation.
    """
    s = _marker_stats(abundance, approx_rsd, counts)
    top = s.orderBy(*nan_low("avg_abundance", ascending=False), "marker_id").limit(k)
    avg = F.round("avg_abundance", digits) if digits is not None else F.col("avg_abundance")
    return top.select("marker_id", "sample_count", avg.alias("avg_abundance"), "max_abundance", "min_abundance")


def top_markers_by_samples(abundance: DataFrame, k: int = 10, digits: int | None = 6,
                           approx_rsd: float | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Markers ranked by the number of samples that carry them (HLL estimate with ``approx_rsd``, exact from ``counts``)."""
    s = _marker_stats(abundance, approx_rsd, counts)
    top = s.orderBy(F.desc("sample_count"), "marker_id").limit(k)
    avg = F.round("avg_abundance", digits) if digits is not None else F.col("avg_abundance")
    return top.select("marker_id", "sample_count", avg.alias("avg_abundance"), "max_abundance")


# Q3 ------------------------------------------------------------------------

def sample_profiles(rel_ab: DataFrame, samples: SampleSet, clade_like: str = KINGDOM_ANY) -> DataFrame:
    """Profiles of chosen samples for clades matching a LIKE pattern."""
    df = restrict_samples(rel_ab, samples).where(F.col("clade_name").like(clade_like))
    return (df.select("sample_id", "clade_name", "relative_abundance", "coverage", "estimated_reads")
              .orderBy("sample_id", *nan_low("relative_abundance", ascending=False)))


# Q4 ------------------------------------------------------------------------

def samples_with_taxon(rel_ab: DataFrame, clade_like: str = "%Bacteroides%", threshold: float = 10.0,
                       k: int = 100, names: DataFrame | None = None) -> DataFrame:
    """Samples where a taxon pattern exceeds a relative abundance threshold.

    Given the table's ``names`` (``operators.companions``), the pattern is matched there, and
    the scan gets the names it stands for.
    """
    taxa = rel_ab.where(F.col("clade_name").like(clade_like)) if names is None else with_names(
        rel_ab, "clade_name", names.where(F.col("name").like(clade_like)))
    df = taxa.where(gt_not_nan("relative_abundance", threshold))
    return (df.select("sample_id", "clade_name", "relative_abundance")
              .orderBy(F.desc("relative_abundance"), "sample_id", "clade_name").limit(k))


# Q5 ------------------------------------------------------------------------

def viral_summary(viruses: DataFrame, min_viruses: int = 5, k: int = 50, digits: int | None = 6) -> DataFrame:
    """Per sample: virus rows, total mapped reads, mean breadth of coverage."""
    s = viruses.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("viral_count"),
        F.sum("mapping_reads_count").cast("bigint").alias("total_viral_reads"),
        F.avg("breadth_of_coverage").alias("avg_coverage"),
    ).where(F.col("viral_count") > min_viruses)
    top = s.orderBy(F.desc("total_viral_reads"), "sample_id").limit(k)
    if digits is not None:
        top = top.withColumn("avg_coverage", F.round("avg_coverage", digits))
    return top


# Q6 ------------------------------------------------------------------------

def marker_presence_comparison(presence: DataFrame, samples: SampleSet, min_present: int = 1) -> DataFrame:
    """Markers present in more than ``min_present`` of the chosen samples.

    ``samples_with_marker`` lists those samples, comma-separated, in id order.
    """
    chosen = restrict_samples(presence.select("sample_id", "marker_id", "presence"), samples)
    s = chosen.groupBy("marker_id").agg(
        count_if(F.col("presence") == 1).alias("present_in_samples"),
        ordered_string_agg("case when presence = 1 then sample_id end").alias("samples_with_marker"),
    ).where(F.col("present_in_samples") > min_present)
    return s.orderBy(F.desc("present_in_samples"), "marker_id")


# Q7 ------------------------------------------------------------------------

def profiles_with_study(rel_ab: DataFrame, sample_map: DataFrame, study: str,
                        clade_like: str = KINGDOM_ANY, k: int = 100) -> DataFrame:
    """Clade rows of one study's samples with their run ids and names.

    The study filter runs on the map before the join; the filtered map is
    broadcast when its size allows.
    """
    m = sample_map.where(F.col("study_name") == study)
    data = rel_ab.where(F.col("clade_name").like(clade_like))
    j = join_sample_map(data, m, ["study_name", "run_ids", "sample_name"])
    return (j.select("study_name", "run_ids", "sample_name", "sample_id", "clade_name", "relative_abundance")
              .orderBy(*nan_low("relative_abundance", ascending=False), "sample_id", "clade_name")
              .limit(k))


# Q8 ------------------------------------------------------------------------

def study_samples_marker_counts(sample_map: DataFrame, abundance: DataFrame,
                                studies: Iterable[str]) -> DataFrame:
    """Every sample of the given studies with its distinct marker count (0 if none).

    Same result as ``map LEFT JOIN fact GROUP BY map columns``, but the fact
    side is first cut to the studies' samples (semi join) and reduced to one
    row per sample before the outer join, so no fan-out is ever shuffled.
    """
    m = sample_map.where(F.col("study_name").isin(list(studies))) \
        .select("sample_id", "run_ids", "sample_name", "study_name").distinct()
    facts = semi_join_keys(abundance.select("sample_id", "marker_id"), m)
    counts = facts.groupBy("sample_id").agg(F.count_distinct("marker_id").alias("marker_count"))
    j = m.join(counts, "sample_id", "left")
    return (j.select("sample_id", "run_ids", "sample_name", "study_name",
                     F.coalesce("marker_count", F.lit(0)).cast("bigint").alias("marker_count"))
              .orderBy(F.desc("marker_count"), "sample_id"))


# Q9 ------------------------------------------------------------------------

def marker_count_per_sample(abundance: DataFrame, n: int | None = 10) -> DataFrame:
    """Rows per sample; the first ``n`` samples by id (all when ``n`` is None)."""
    s = abundance.groupBy("sample_id").agg(F.count(F.lit(1)).alias("marker_count")).orderBy("sample_id")
    return s.limit(n) if n else s


# Q10 / Q11 -----------------------------------------------------------------

def approx_distinct_samples(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    """HyperLogLog++ estimate of the number of distinct samples."""
    return df.agg(F.approx_count_distinct("sample_id", rsd).alias("approx_samples"))


def sampled_scan(df: DataFrame, percent: float = 1.0, by_sample: bool = False,
                 seed: int | None = 42, limit: int | None = 1000) -> DataFrame:
    """A ``percent`` % sample of rows (or of whole samples), optionally capped."""
    s = sample_keys(df, percent) if by_sample else sample_rows(df, percent, seed)
    return s.limit(limit) if limit else s


# Q12 / Q13 -----------------------------------------------------------------

def first_samples(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest distinct sample ids."""
    return df.select("sample_id").distinct().orderBy("sample_id").limit(n)


def first_sample_ids(df: DataFrame, n: int) -> list[str]:
    """The ``n`` smallest distinct sample ids as a list.

    Only the ``sample_id`` column is scanned, with partial aggregation and a
    top-n; the list is bounded by ``n``.
    """
    return [r[0] for r in first_samples(df, n).collect()]


def kingdom_rows(rel_ab: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Rows at kingdom level only: ``k__X`` without a deeper rank; with the table's ``names`` the few that are."""
    if names is not None:
        return with_names(rel_ab, "clade_name", names.where(F.col("name").like(KINGDOM_ANY) & ~F.col("name").like(KINGDOM_DEEPER)))
    return rel_ab.where(F.col("clade_name").like(KINGDOM_ANY) & ~F.col("clade_name").like(KINGDOM_DEEPER))


def kingdom_composition_long(rel_ab: DataFrame, n_samples: int = 10,
                             samples: SampleSet | None = None, names: DataFrame | None = None) -> DataFrame:
    """Kingdom-level rows (``k__X`` without deeper ranks) of ``n`` samples.

    Like the two-step original (distinct ids, then ``IN UNNEST(ids)``): the
    bounded list of the first ``n`` ids is fetched, then pushed to the scan as
    ``IN`` so Parquet statistics and bloom filters on the clustered
    ``sample_id`` skip all other row groups.  More than ``MAX_ID_LIST`` ids, or a
    DataFrame of ids, are semi joined in one plan instead.
    """
    return (_chosen_kingdom_rows(rel_ab, n_samples, samples, names)
            .orderBy("sample_id", *nan_low("relative_abundance", ascending=False)))


def _chosen_kingdom_rows(rel_ab: DataFrame, n_samples: int, samples: SampleSet | None, names: DataFrame | None = None) -> DataFrame:
    chosen = samples
    if chosen is None:
        chosen = first_sample_ids(rel_ab, n_samples) if n_samples <= MAX_ID_LIST else first_samples(rel_ab, n_samples)
    data = restrict_samples(kingdom_rows(rel_ab, names), chosen)
    return data.select("sample_id", "clade_name", "relative_abundance")


def kingdom_composition_wide(rel_ab: DataFrame, n_samples: int = 10, cell: str = "unique",
                             samples: SampleSet | None = None, kingdoms: list[str] | None = None) -> DataFrame:
    """The long composition pivoted: one row per sample, one column per kingdom.

    Pivots the unsorted rows: row order is irrelevant to a pivot.  ``kingdoms`` names
    the columns and saves the pass that looks them up.
    """
    rows = _chosen_kingdom_rows(rel_ab, n_samples, samples)
    return pivot_wide(rows, "sample_id", "clade_name", "relative_abundance", values=kingdoms, cell=cell)
