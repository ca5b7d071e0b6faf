"""Grouped statistics used by the analytical queries.

All are plain ``groupBy().agg()`` so Spark does map-side partial aggregation
before any shuffle; a hot key costs one partial row per task.  A single
``count_distinct`` next to other aggregates is planned by Spark as a
two-level aggregation on (key, distinct column) then key, with no Expand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions.columns import min_nan_first


def value_stats(df: DataFrame, key: str | list[str], value: str, distinct_of: str = "sample_id",
                count_name: str = "sample_count", prefix: str | None = None,
                approx_rsd: float | None = None, count: bool = True) -> DataFrame:
    """Per ``key``: distinct ``distinct_of`` count, mean, max and min of ``value``.

    ``min`` returns NaN when any value is NaN, like the warehouse does.
    ``approx_rsd`` swaps the exact distinct count for HyperLogLog++ with that
    relative standard deviation: one aggregation level and one exchange
    instead of two, for very large tables; ``count=False`` leaves the count out.
    """
    p = prefix or value
    distinct = (F.approx_count_distinct(distinct_of, approx_rsd) if approx_rsd
                else F.count_distinct(distinct_of))
    return df.groupBy(key).agg(
        *([distinct.alias(count_name)] if count else []),
        F.avg(value).alias(f"avg_{p}"),
        F.max(value).alias(f"max_{p}"),
        min_nan_first(value).alias(f"min_{p}"),
    )


def count_if(pred: Column) -> Column:
    """``COUNTIF(pred)`` as a bigint."""
    return F.count_if(pred).cast("bigint")

