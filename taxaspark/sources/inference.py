"""Column types of text, as a lattice that merges in any order.

Every value has one narrowest kind; the kinds of a column's values, as bits, merge by OR, so partial
results of tasks (also of repeated ones) combine to the same answer.  The type for a set of kinds is
the one that Spark's own CSV inference comes to, with integers widened to 64 bits.  One case differs: of a
whole number and a date, Spark's answer depends on which it meets first; here it is text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT, LONG, BIG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
NUMBERS, TIMES = INT | LONG | BIG | DOUBLE, DATE | TIMESTAMP


def kind(c: Column) -> Column:
    """Bit of the narrowest type that a text reads as; null for a null or empty text."""
    whole = c.rlike(r"^[+-]?[0-9]+\.?$")  # "5." counts as a decimal of no places
    number = c.rlike(r"^[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)[\x00-\x20]*$") | c.isin("Inf", "-Inf")
    day = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull()
    return (F.when(c.isNull() | (c == ""), F.lit(None))
            .when(whole & ~c.endswith(".") & c.try_cast("int").isNotNull(), F.lit(INT))
            .when(whole & ~c.endswith(".") & c.try_cast("bigint").isNotNull(), F.lit(LONG))
            .when(whole, F.lit(BIG)).when(number, F.lit(DOUBLE)).when(day, F.lit(DATE))
            .when(c.try_cast("timestamp").isNotNull(), F.lit(TIMESTAMP))
            .when(F.lower(c).isin("true", "false"), F.lit(BOOLEAN)).otherwise(F.lit(TEXT)))


def digits(c: Column) -> Column:
    """Digits of a whole number."""
    return F.length(F.regexp_extract(c, r"^[+-]?0*([0-9]+)\.?$", 1))


def summary(values: list[Column]) -> list[Column]:
    """Aggregates ``kinds_i`` and ``digits_i`` of the i-th texts, that ``resolved`` reads."""
    return [a for i, c in enumerate(values)
            for a in (F.coalesce(F.bit_or(kind(c)), F.lit(0)).alias(f"kinds_{i}"), F.coalesce(F.max(digits(c)), F.lit(0)).alias(f"digits_{i}"))]


def resolve(kinds: int, most_digits: int) -> T.DataType:
    """Type of a column with these kinds of values."""
    if kinds and not kinds & ~NUMBERS:
        if kinds & DOUBLE or (kinds & BIG and most_digits > 38):
            return T.DoubleType()
        if kinds & BIG:  # wide enough for all of the column's integers
            return T.DecimalType(max(20 if kinds & LONG else 10 if kinds & INT else 1, most_digits), 0)
        return T.LongType()
    if kinds and not kinds & ~TIMES:
        return T.TimestampType() if kinds & TIMESTAMP else T.DateType()
    return T.BooleanType() if kinds == BOOLEAN else T.StringType()


def resolved(columns: list[str], found: dict) -> T.StructType:
    return T.StructType([T.StructField(c, resolve(found[f"kinds_{i}"], found[f"digits_{i}"])) for i, c in enumerate(columns)])
