"""Sampling scans."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_DIGITS = 15  # hex digits of the key's md5 that decide: shares down to 16 ** -15


def sample_rows(df: DataFrame, percent: float, seed: int | None = None) -> DataFrame:
    """Row-level Bernoulli sample of about ``percent`` % of the rows."""
    return df.sample(withReplacement=False, fraction=percent / 100.0, seed=seed)


def sample_blocks(df: DataFrame, percent: float, seed: int = 0) -> DataFrame:
    """Block sample: all rows of about ``percent`` % of the files of ``df``, a plain scan of a table.

    A file is in the sample or not by a hash of its name, which is a constant of the file, so the
    others are dropped while files are listed and never opened: what is read falls with the sample.  Rows of a
    file come together, as with any block sample; ``sample_rows`` reads everything and draws rows alone.
    The finer the table's files (``partitions`` of ``write_table``), the finer the sample.
    """
    share = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.col("_metadata.file_name"))), 1, HASH_DIGITS), 16, 10).cast("long")
    return df.where(share < F.lit(key_bound(percent)))


def key_bound(percent: float) -> int:
    """Keys whose hash lies below this are in a sample of ``percent`` %."""
    return int(Fraction(str(percent)) * 16 ** HASH_DIGITS / 100)


def sample_keys(df: DataFrame, percent: float, key: str = "sample_id") -> DataFrame:
    """Whole-key sample: every row of about ``percent`` % of the keys.

    The choice is a hash of the key, so it is stable across runs and tables
    (the same samples are picked from every dataset), and on raw scans it
    prunes files because ``sample_id`` is constant per file.
    """
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, HASH_DIGITS)
    return df.where(F.conv(digits, 16, 10).cast("long") < F.lit(key_bound(percent)))
