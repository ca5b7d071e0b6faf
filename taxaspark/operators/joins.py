"""Joins of fact tables with the sample map.

Plain lazy joins: nothing is hinted or measured when a plan is built.  AQE
broadcasts a side whose real size is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(set in ``session.DEFAULT_CONF``) and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def semi_join_keys(fact: DataFrame, keys: DataFrame, on: str = "sample_id") -> DataFrame:
    """Rows of ``fact`` whose ``on`` value appears in ``keys`` (a semi join needs no distinct keys)."""
    return fact.join(keys.select(on), on, "left_semi")


def join_sample_map(fact: DataFrame, sample_map: DataFrame, map_columns: list[str]) -> DataFrame:
    """Inner join ``fact`` ⋈ ``sample_map`` on ``sample_id``; duplicate map keys fan out rows, as in SQL."""
    return fact.join(sample_map.select("sample_id", *map_columns), "sample_id", "inner")
