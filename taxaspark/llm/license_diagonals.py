"""License notices by diagonal voting.

Every word k-gram of a text (k = 3, or 2 for phrases of two words) is hashed and joined with the
positions of the templates' k-grams; the words are compared too, so hashes that clash don't count.
A hit at word p of the text and word t of the template votes for the diagonal p - t.  Votes
are aggregated by (text, template, diagonal); a diagonal takes in its neighbours up to
``GAP`` words away (words added or left out move the rest to a neighbour), and stands if none of
these has more votes.  Its span is verified by the words matched: the share of the
template's words that lie in hits, over the longer of template and span, must reach ``LEAST``.
Phrases are templates of at most three words; they have one k-gram, aren't merged and match as a whole.

One pass over the texts writes the hits and one row a document; only these are shuffled.  The
template table is a constant of this module (``gram_rows``) and is broadcast.  A group is at most
one document's hits on one template; window frames hold 2 ``GAP`` + 1 diagonals of at most a template's length.

Defined cases: null text is empty; repeated rows are documents of their own, whatever their doc_id;
a document without hits has no labels and score 0; diagonals with equal votes: the smallest stands; an
empty table gives an empty result; other columns aren't read.  Texts of any length are read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taxaspark.llm.common import text_bytes, written

K = 3
GAP = 4
LEAST = 0.8

#: ASCII separators of words; all else (digits, lower-case letters, all beyond ASCII) belongs to words.
SEPARATORS = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"

# Phrases and label names.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed values: (label, wording) of well-known license notices.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
     to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
     whom the Software is furnished to do so, subject to the following conditions"""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
     on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
     specific language governing permissions and limitations under the License."""),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
     License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("gpl-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
     License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
     following conditions are met"""),
    ("bsd", """Redistributions of source code must retain the above copyright notice, this list of conditions and the following
     disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
     following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "Creative Commons Zero v1.0 Universal"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
]


def words_of(text: str) -> list[str]:
    """Words of a template, as the texts' words are found."""
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(f"[^{SEPARATORS}]+", lower)


def templates(phrases: dict[str, str] = PHRASES, notices=NOTICES) -> list[tuple[int, str, bool, list[str]]]:
    """(template, label, is it a phrase, words)."""
    all_ = [(label, True, words_of(p)) for p, label in phrases.items()] + [(label, False, words_of(t)) for label, t in notices]
    return [(i, *t) for i, t in enumerate(all_)]


def gram_rows(temps) -> list[tuple]:
    """(template, label, phrase, words in all, k, place, w0, w1, w2) of every k-gram; k is 2 for two words (w2 is null)."""
    out = []
    for i, label, phrase, words in temps:
        k = min(K, len(words))
        if k < 2 or (phrase and len(words) > K):
            raise ValueError(f"a template has 2 words at least, a phrase {K} at most: {words}")
        out += [(i, label, phrase, len(words), k, p, *(words[p:p + k] + [None] * (K - k))) for p in range(len(words) - k + 1)]
    return out


def _hash(*words: Column) -> Column:
    """Hash of a k-gram; null where a word is missing, as at a text's end."""
    return F.when(words[-1].isNotNull(), F.xxhash64(*words))


def hits(docs: DataFrame, temps) -> DataFrame:
    """One row a k-gram hit, and one more a document (``template`` null): (rid, doc_id, n_words, template, label, phrase, size, k, place, at)."""
    spark = docs.sparkSession
    rows = gram_rows(temps)
    grams = spark.createDataFrame(rows, "template int, label string, phrase boolean, size int, k int, place int, t0 string, t1 string, t2 string")
    grams = grams.withColumn("hash", F.when(F.col("k") == 2, F.xxhash64("t0", "t1")).otherwise(F.xxhash64("t0", "t1", "t2")))
    lower = F.translate(text_bytes().cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(f"[^{SEPARATORS}]+"), F.lit(0))
    base = docs.select("doc_id", words.alias("w")).withColumn("rid", F.monotonically_increasing_id())
    size = F.size("w")
    following = [F.slice("w", 1 + i, F.greatest(size - i, F.lit(0))) for i in range(K)]
    each = base.select("rid", "doc_id", size.cast("long").alias("n_words"),
                       F.posexplode_outer(F.arrays_zip(*[x.alias(f"w{i}") for i, x in enumerate(following)])).alias("at", "z"))
    each = each.select("rid", "doc_id", "n_words", "at", *[F.col(f"z.w{i}") for i in range(K)])
    two = sorted({r[6] for r in rows if r[4] == 2})
    keys = F.array(_hash(*[F.col(f"w{i}") for i in range(K)]))
    if two:
        keys = F.when(F.col("w0").isin(two), F.concat(keys, F.array(_hash(F.col("w0"), F.col("w1"))))).otherwise(keys)
    each = each.withColumn("hash", F.explode(keys))
    t = grams.withColumnRenamed("hash", "t_hash")
    same = ((F.col("hash") == F.col("t_hash")) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1"))
            & (F.col("t2").isNull() | (F.col("w2") == F.col("t2"))))
    found = each.join(F.broadcast(t), same, "left").where("template is not null or coalesce(at, 0) = 0")
    return found.select("rid", "doc_id", "n_words", "template", "label", "phrase", "size", "k", "place", F.col("at").cast("long").alias("at"))


def spans(found: DataFrame) -> DataFrame:
    """(rid, template, label, phrase, first, last, likeness) of verified spans; words ``first`` to ``last`` of the text."""
    by = ["rid", "template", "label", "phrase", "size", "k"]
    lines = (found.where("template is not null").groupBy(*by, (F.col("at") - F.col("place")).alias("diagonal"))
             .agg(F.collect_list("place").alias("places"), F.count("*").alias("votes"),
                  F.min("at").alias("low"), F.max(F.col("at") + F.col("k") - 1).alias("high")))
    # A phrase's diagonals are kept apart by stretching them beyond the reach of the frame.
    at = F.col("diagonal") * F.when(F.col("phrase"), F.lit(GAP + 1)).otherwise(F.lit(1))
    near = W.partitionBy("rid", "template").orderBy(at).rangeBetween(-GAP, GAP)
    merged = lines.select(*by, "diagonal", F.flatten(F.collect_list("places").over(near)).alias("places"),
                          F.min("low").over(near).alias("first"), F.max("high").over(near).alias("last"),
                          F.max(F.struct("votes", -F.col("diagonal"))).over(near).alias("best"), "votes")
    merged = merged.where((F.col("best.votes") == F.col("votes")) & (F.col("best.col2") == -F.col("diagonal")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    likeness = covered.cast("double") / F.greatest(F.col("size").cast("long"), F.col("last") - F.col("first") + 1)
    return (merged.select("rid", "template", "label", "phrase", "first", "last", likeness.alias("likeness"))
            .where(F.col("likeness") >= LEAST))


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices=NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    found = written(hits(docs, templates(phrases, notices)), "license_hits")
    rows = found.where("coalesce(at, 0) = 0").groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"))
    marks = spans(found).select("rid", "label", "phrase", "first", "likeness")

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(labels)), ",")

    base = F.when(F.col("phrase"), F.col("first"))
    return (rows.unionByName(marks, allowMissingColumns=True).groupBy("rid")
            .agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count(base).alias("n_base"),
                 F.min(base).alias("first_word"), F.max(base).alias("last_word"), joined(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"),
                 joined(F.col("label")).alias("labels"), F.coalesce(F.max("likeness"), F.lit(0.0)).alias("score"))
            .drop("rid"))
