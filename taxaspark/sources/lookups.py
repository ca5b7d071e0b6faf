"""Lookup sources: the sample map CSV and the accession dump TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.schemas import SAMPLE_MAP_SCHEMA
from taxaspark.session import scratch_path
from taxaspark.sources.inference import resolved, summary
from taxaspark.sources.quoted import read_quoted


def read_sample_map(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """Sample map CSV: comma, one header line, quoted newlines, UTF-8, declared schema.

    Quoted newlines stay inside their row, and the file is read in blocks all the same (``sources.quoted``);
    a malformed row fails.
    """
    return read_quoted(spark, path, ",", SAMPLE_MAP_SCHEMA, block_bytes)


#: No field of a dump holds this; it keeps Spark from reading empty fields as NULL.
_NO_MARKER = "\u0000"


def _reader(spark: SparkSession):
    return (spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST"))


def accession_texts(spark: SparkSession, path: str, multiline: bool = True, names: list[str] | None = None,
                    block_bytes: int | None = None) -> DataFrame:
    """All fields of an accession dump as text; an empty field is NULL.  Rows with the wrong number of fields fail.

    Quoted newlines are allowed and read in parallel; ``multiline=False`` leaves out the pass
    that looks for them (a split row then fails loudly).
    """
    names = names or _reader(spark).csv(path).columns
    texts = T.StructType([T.StructField(c, T.StringType()) for c in names])
    if multiline:
        return read_quoted(spark, path, "\t", texts, block_bytes)
    return _reader(spark).option("nullValue", _NO_MARKER).schema(texts).csv(path)


def accession_columns(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Text fields to their types: '-' is NULL; an empty field is an empty string in a text column, else NULL."""
    cols = []
    for f in schema.fields:
        c = F.nullif(F.col(f"`{f.name}`"), F.lit("-"))
        if isinstance(f.dataType, T.StringType):
            c = F.when(F.col(f"`{f.name}`").isNull(), F.lit("")).otherwise(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return texts.select(*cols)


def read_accessions(spark: SparkSession, path: str, multiline: bool = True, schema: T.StructType | None = None,
                    scratch: str | None = None, block_bytes: int | None = None) -> DataFrame:
    """Accession dump: tab-separated with a header, '-' is NULL, types inferred; the dump is read once.

    Without a ``schema`` the fields are written to the folder ``scratch`` as text, and that job notes
    the kinds of values of each column (``sources.inference``: an OR, so a task that runs twice changes
    nothing); the typed rows then come from there.  See ``accession_texts`` and ``accession_columns``.
    """
    texts = accession_texts(spark, path, multiline, schema and schema.names, block_bytes)
    if schema is None:
        scratch = scratch or scratch_path(spark, "accession_texts")
        kinds = Observation()
        values = [F.nullif(F.col(f"`{c}`"), F.lit("-")) for c in texts.columns]
        texts.observe(kinds, *summary(values)).write.parquet(scratch)
        schema = resolved(texts.columns, kinds.get)
        texts = spark.read.schema(texts.schema).parquet(scratch)
    return accession_columns(texts, schema)
