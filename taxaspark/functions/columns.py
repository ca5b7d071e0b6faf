"""Scalar column expressions (all JVM-side built-ins, no Python UDFs).

They encode the warehouse semantics the queries depend on where Spark's
defaults differ: NULL when a regex does not match, lenient casts that never
raise under ANSI mode, and NaN handling that treats NaN as unordered.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.schemas import DEFAULT_RUN_TAG


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sample_id_pattern(run_tag: str = DEFAULT_RUN_TAG) -> str:
    return f"/{re.escape(run_tag)}/([^/]+)/"


def sample_id_from_path(path, run_tag: str = DEFAULT_RUN_TAG, pattern: str | None = None,
                        decode: bool = True) -> Column:
    """Path segment after ``/<run_tag>/``; NULL when the path has no such segment.

    ``pattern`` (a regex with one group) replaces the run-tag rule.  Spark's
    ``regexp_extract`` yields '' on no match, so ``nullif`` is needed for the
    staging filter ``sample_id IS NOT NULL`` to drop such rows.  File paths
    from ``_metadata.file_path`` are URIs (a space is ``%20``); ``decode``
    turns the path back into plain folder names first ('+' is kept as it is).
    """
    rx = pattern or sample_id_pattern(run_tag)
    p = _col(path)
    if decode:  # a '/' never comes out of decoding a folder name, so segments stay intact
        p = F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B")))
    return F.nullif(F.regexp_extract(p, rx, 1), F.lit(""))


def null_sentinel(c, sentinel: str = "-") -> Column:
    """``NULLIF(c, sentinel)``."""
    return F.nullif(_col(c), F.lit(sentinel))


# Spark's string->double cast accepts a trailing type suffix ('1.0d', '2f') and hex floats
# ('0x1p3'); a warehouse SAFE_CAST does not, so such strings are made NULL first.
_SUFFIX_RE = r"(?i)[0-9.][df]\s*$"
_HEX_RE = r"^\s*[+-]?0[xX]0*[0-9a-fA-F]{1,16}\s*$"


def lenient_double(c, source_type: T.DataType | None = None) -> Column:
    """``SAFE_CAST(c AS FLOAT64)``: NULL instead of an error on bad input."""
    col = _col(c)
    if source_type is not None and not isinstance(source_type, T.StringType):
        return col.try_cast(T.DoubleType())
    # Cheap precheck first: only strings holding a d or f can carry the
    # suffix, so the regex runs on almost no rows.
    maybe = col.contains("d") | col.contains("D") | col.contains("f") | col.contains("F")
    suffixed = maybe & col.rlike(_SUFFIX_RE)
    hexed = col.contains("x") | col.contains("X")
    return F.when(suffixed | hexed, F.lit(None).cast(T.DoubleType())).otherwise(col.try_cast(T.DoubleType()))


def lenient_long(c, source_type: T.DataType | None = None) -> Column:
    """``SAFE_CAST(c AS INT64)``: decimal or 0x-hex integers, NULL otherwise."""
    col = _col(c)
    if source_type is not None and not isinstance(source_type, T.StringType):
        return col.try_cast(T.LongType())
    magnitude = F.conv(F.regexp_extract(col, r"0[xX]0*([0-9a-fA-F]+)", 1), 16, 10).try_cast(T.LongType())
    negative = F.regexp_extract(col, r"^\s*([+-]?)0[xX]", 1) == "-"
    hex_value = F.when(negative, -magnitude).otherwise(magnitude)
    # Only strings holding an 'x' can be hex; the regex runs on those alone.
    is_hex = (col.contains("x") | col.contains("X")) & col.rlike(_HEX_RE)
    return F.when(is_hex, hex_value).otherwise(col.try_cast(T.LongType()))


def gt_not_nan(c, value) -> Column:
    """``c > value`` that is false for NaN (Spark orders NaN above +inf)."""
    col = _col(c)
    return (col > F.lit(value)) & ~F.isnan(col)


def min_nan_first(c) -> Column:
    """Aggregate ``MIN`` that returns NaN when any input is NaN.

    Spark's ``min`` skips NaN because it orders NaN highest.
    """
    col = _col(c)
    return F.when(F.bool_or(F.isnan(col)), F.lit(float("nan"))).otherwise(F.min(col))


def ordered_string_agg(c, delimiter: str = ",", order_by: str | None = None) -> Column:
    """``STRING_AGG(c)`` with the warehouse's ',' default; NULLs skipped.

    Ordered by the value itself (or ``order_by``) so that the output is
    deterministic; with no non-NULL input the result is NULL.
    """
    expr = c if isinstance(c, str) else None
    if expr is None:
        raise TypeError("ordered_string_agg takes a SQL expression string")
    key = order_by or expr
    delim = delimiter.replace("'", "''")
    return F.expr(f"string_agg({expr}, '{delim}') within group (order by {key})")

