import random

import pytest

#: Names that operators use inside; a table may have columns called the same.
CLASHES = {"fp": "bigint", "key": "string", "n": "int", "shard": "int", "kept": "boolean", "score": "double", "rid": "bigint",
           "bucket": "int", "set": "string", "rows": "int", "size": "int", "N_WORDS": "string", "__row": "int", "rule": "string"}


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice(["ba", "ne", "ti", "or", "sha", "lu"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def texts(words):
    """Plain prose, copies, near copies, junk, long and degenerate texts."""
    rng = random.Random(5)
    prose = [" ".join(rng.choice(words) + rng.choice(["", "", "", ".\n"]) for _ in range(rng.randint(12, 150))) for _ in range(60)]
    near = [prose[0] + " extra", prose[1].upper(), prose[2].replace(" ", "  ")]
    odd = [None, "", " ", "\n\n", "a", "a b", "x" * 30_000, "é▁ 日本\x00𝔘 <|endoftext|>", "Und " * 400, "spam!! " * 50,
           "line of words\n" * 30, "\r\n\t\v\f", " ".join(rng.choice(words) for _ in range(20_000))]
    return prose + prose[:6] + [prose[3]] * 12 + near + odd


def with_clashes(df):
    """``df`` with more columns, named like those that operators make."""
    from pyspark.sql import functions as F
    have = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit("1").cast(t).alias(c) for c, t in CLASHES.items() if c.lower() not in have])


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s1"][i % 4]) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id here", "en", "s1")]  # repeated rows, and one without an id
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    return with_clashes(df).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def pdf(docs):
    return docs.select("doc_id", "text", "lang", "source").toPandas()
