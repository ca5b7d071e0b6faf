"""Materialised tables: scans, and full refreshes that readers never see half done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from taxaspark.sources.snapshots import folder, publish


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The table published at ``path`` (or a plain Parquet folder there)."""
    return spark.read.parquet(folder(spark, path))


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    return open_table(spark, table_path(warehouse, name))


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None], check: Callable[[DataFrame], object] | None = None,
                  keys: list[str] | None = None, counts: Callable[[], dict] | None = None,
                  companions: dict[str, Callable[[DataFrame], DataFrame]] | None = None):
    """Full refresh: write beside, read back, check, then switch; returns what ``check`` returns.

    ``path`` stands for the old table until the new one is whole and checked; a failure leaves it
    as it was (see ``snapshots``).
    """
    return publish(spark, path, write, keys or [], check, counts, companions=companions)[1]
