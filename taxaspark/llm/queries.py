"""The operators applied to the benchmark tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from taxaspark.llm import license_diagonals as D
from taxaspark.llm import phrase_stripes as S
from taxaspark.llm import quality_rules as R
from taxaspark.llm.common import table
from taxaspark.llm.html_tagpath import extract_pages
from taxaspark.llm.iblt import fingerprint_documents
from taxaspark.llm.license_diagonals import license_scan
from taxaspark.llm.lm_maxent import lm_scores
from taxaspark.llm.packing import pack_documents
from taxaspark.llm.phrase_stripes import collocations
from taxaspark.llm.piece_sampling import sample_pieces
from taxaspark.llm.prefix_trie import conversation_trie
from taxaspark.llm.quality_classifier import quality_scores
from taxaspark.llm.quality_rules import quality_rules
from taxaspark.llm.sharding_lpa import shard_documents
from taxaspark.llm.simhash_vptree import near_duplicates
from taxaspark.llm.url_charlm import judge_urls

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def byte_bpe_files() -> tuple[str, str]:
    """Rank file and split pattern of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def byte_bpe_added() -> dict[str, int]:
    """Added tokens of the same vocabulary's JSON file, which the rank file leaves out, with their ids."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), *byte_bpe_files(), added=byte_bpe_added())


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sample_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_packing": op2_packing,
    "op3_sharding": op3_sharding,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_url_filters": op7_url_filters,
    "op8_sentencepiece_sampling": op8_sentencepiece_sampling,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_license_scans": op12_license_scans,
    "op13_phrase_collocations": op13_phrase_collocations,
}


def quality_rules_sql() -> str:
    """``op10`` in DuckDB SQL: counts, sketches per group, language and table, fences, verdict."""
    ratio = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
             "repeat_words": ("n_repeat_words", "n_words"), "upper": ("n_upper", "word_chars")}
    value = {k: f"coalesce(1000.0 * {a} / nullif({b}, 0), 0.0)" for k, (a, b) in ratio.items()}
    each = "\nunion all ".join(f"select lang, source, '{k}' as ratio, {R.RATIOS[k]} as least, cast({v} as double) as v from stats" for k, v in value.items())
    levels = [("2", "lang, source"), ("1", "lang, null"), ("0", "null, null")]
    bins = "\nunion all ".join(f"select {n} as level, {keys.split(', ')[0]} as lang, {keys.split(', ')[1]} as source, ratio, least, bin, count(*) as n "
                               f"from binned group by all" for n, keys in levels)
    fence = "\n  ".join(f"""and {value[k]} <= coalesce(
    (select f.fence from fences f where f.level = 2 and f.rows >= {R.MIN_ROWS} and f.ratio = '{k}' and f.lang is not distinct from s.lang and f.source is not distinct from s.source),
    (select f.fence from fences f where f.level = 1 and f.rows >= {R.MIN_ROWS} and f.ratio = '{k}' and f.lang is not distinct from s.lang),
    (select f.fence from fences f where f.level = 0 and f.ratio = '{k}'))""" for k in ratio)
    white = r"[^\x20\x09-\x0D]"
    return f"""
with texts as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text from documents),
split as (select *, regexp_extract_all(text, '{white}+') as words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{white}')) as lines from texts),
windows as (select rid, i, list_slice(words, i, i + 4) as w from split, unnest(range(1, len(words) - 3)) as t(i)),
again as (select rid, i from (select rid, i, count(*) over (partition by rid, w) as n from windows) where n > 1),
covered as (select rid, count(distinct i + k) as n_repeat_words from again, unnest(range(5)) as t(k) group by rid),
stats as (select rid, doc_id, lang, source, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words, len(lines) as n_lines, len(regexp_extract_all(text, '[A-Z]')) as n_upper
  from split left join covered using (rid)),
binned as (select lang, source, ratio, least, case when v <= 0 then -1 else greatest(0, ceil(ln(v) / ln({R.GAMMA}))) end as bin from ({each})),
sketches as ({bins}),
running as (select *, sum(n) over (partition by level, lang, source, ratio order by bin) as upto,
  sum(n) over (partition by level, lang, source, ratio) as total, case when bin < 0 then 0.0 else pow({R.GAMMA}, bin) end as v from sketches),
quartiles as (select level, lang, source, ratio, any_value(least) as least, max(total) as rows,
  min(v) filter (where upto >= 0.25 * total) as q25, min(v) filter (where upto >= 0.75 * total) as q75 from running group by level, lang, source, ratio),
fences as (select *, q75 + {R.SPREAD} * greatest(q75 - q25, least) as fence from quartiles)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
  {fence} as kept
from stats s"""


def prefix_trie_sql() -> str:
    """``op11`` in DuckDB SQL: sequences as lists, subtrees by comparing their beginnings."""
    return """
with turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
  row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i from conversations where conv_id is not null),
bits as (select conv_id, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(cast(conv_id as varchar), ''),
    lambda ch: [cast(ascii(ch) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end) as crc
  from (select distinct conv_id from turns)),
heads as (select conv_id, xor(crc, 4294967295) % 9 as h from bits),
rebuilt as (select h.conv_id, t.i, 0 as own, t.role, t.text from heads h join turns t on t.conv_id = h.conv_id - h.conv_id % 5 and t.i <= h.h
  union all select h.conv_id, t.i, 1, t.role, t.text from heads h join turns t on t.conv_id = h.conv_id and t.i > h.h),
steps as (select conv_id, row_number() over w as depth, strlen(text) as n_bytes,
  list(sha256(strlen(role) || ':' || role || text)) over (partition by conv_id order by own, i rows unbounded preceding) as seq
  from rebuilt window w as (partition by conv_id order by own, i)),
paths as (select conv_id, depth, n_bytes, seq from steps
  union all select conv_id, 0, 0, cast([] as varchar[]) from heads),
lengths as (select conv_id, max(depth) as length from paths group by conv_id),
nodes as (select p.seq, min(p.depth) as depth, min(p.conv_id) as conv_id, count(*) as n_convs, min(n_bytes) as n_bytes,
  coalesce(string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) filter (where l.length = p.depth), '') as ends
  from paths p join lengths l using (conv_id) group by p.seq),
children as (select seq[1:depth - 1] as up, count(*) as n from nodes where depth > 0 group by up),
counted as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c on c.up = n.seq),
below as (select seq[1:k] as top, n_children, (n_convs - 1) * n_bytes as saved from counted, unnest(range(depth + 1)) as t(k)),
sums as (select top, count(*) filter (where n_children = 0) as n_leaves, sum(saved) as saved from below group by top)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
  cast(s.saved as bigint) as saved_tokens, sha256(n.ends) as ends_sha256
from counted n join sums s on s.top = n.seq left join nodes p on n.depth > 0 and p.seq = n.seq[1:n.depth - 1]"""


def license_scan_sql() -> str:
    """``op12`` in DuckDB SQL: k-grams joined on their words, diagonals, the strongest of neighbours, verified spans."""
    def quoted(x):
        return "null" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x + "'"

    grams = ",\n".join("(" + ", ".join(map(quoted, r)) + ")" for r in D.gram_rows(D.templates()))
    reach = D.GAP
    return f"""
with grams(template, label, phrase, size, k, place, t0, t1, t2) as (values {grams}),
texts as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^{D.SEPARATORS}]+') as w from documents),
each as (select rid, i - 1 as pos, w[i] as w0, w[i + 1] as w1, w[i + 2] as w2 from texts, unnest(range(1, len(w) + 1)) as t(i)),
hits as (select rid, template, label, phrase, size, k, place, pos from each join grams
  on w0 = t0 and w1 = t1 and (t2 is null or w2 = t2)),
lines as (select rid, template, label, phrase, size, k, pos - place as diagonal, list(place) as places, count(*) as votes,
  min(pos) as low, max(pos + k - 1) as high from hits group by all),
stretched as (select *, diagonal * case when phrase then {reach + 1} else 1 end as d from lines),
merged as (select rid, label, phrase, size, k, votes, diagonal, flatten(list(places) over near) as places, min(low) over near as first,
  max(high) over near as last, max((votes, -diagonal)) over near as best from stretched
  window near as (partition by rid, template order by d range between {reach} preceding and {reach} following)),
verified as (select rid, label, phrase, first, cast(len(list_distinct(flatten(list_transform(places, lambda p: range(p, p + k))))) as double)
  / greatest(size, last - first + 1) as likeness from merged where best = (votes, -diagonal)),
marks as (select * from verified where likeness >= {D.LEAST})
select any_value(t.doc_id) as doc_id, cast(any_value(len(t.w)) as bigint) as n_words, count(*) filter (where phrase) as n_base,
  cast(min(first) filter (where phrase) as bigint) as first_word, cast(max(first) filter (where phrase) as bigint) as last_word,
  coalesce(string_agg(distinct label, ',' order by label) filter (where phrase), '') as base_labels,
  coalesce(string_agg(distinct label, ',' order by label), '') as labels, coalesce(max(likeness), 0.0) as score
from texts t left join marks m using (rid) group by t.rid"""


def collocations_sql() -> str:
    """``op13`` in DuckDB SQL: every phrase counted, cuts scored, phrases inside as frequent longer ones dropped."""
    return f"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
split as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
sizes as (select lang, cast(sum(len(w)) as bigint) as n from split group by lang),
counts as (select lang, m, list_slice(w, i, i + m - 1) as w, count(*) as f from split, unnest(range(1, 5)) as s(m),
  unnest(range(1, len(w) - m + 2)) as t(i) group by all having count(*) >= {S.LEAST}),
cuts as (select c.lang, c.w, c.f as a, k, l.f as l, r.f as r,
  cast((2000000 * cast(c.f as hugeint)) // (cast(l.f as hugeint) + r.f) as bigint) as score
  from counts c, unnest(range(1, c.m)) as t(k) join counts l on l.lang = c.lang and l.w = c.w[1:k] join counts r on r.lang = c.lang and r.w = c.w[k + 1:]),
lowest as (select lang, w, a, min((score, k, l, r)) as cut from cuts group by lang, w, a),
inside as (select lang, list_slice(w, i, i + n - 1) as w, f from counts, unnest(range(2, m)) as s(n), unnest(range(1, m - n + 2)) as t(i) where m > 2),
longest as (select lang, w, max(f) as f from inside group by lang, w),
kept as (select o.lang, array_to_string(o.w, ' ') as phrase, a, cut[1] as score, cut[3] as l, cut[4] as r from lowest o
  left join longest g on g.lang = o.lang and g.w = o.w where not coalesce(100 * cast(g.f as hugeint) >= {S.SUBSUMED} * cast(a as hugeint), false)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang) where rank <= {S.TOP}"""


#: Where SQL can express the operator; the others are held against brute force in tests/llm.
ORACLES: dict[str, str] = {"op10_quality_rules": quality_rules_sql(), "op11_prefix_trie": prefix_trie_sql(),
                           "op12_license_scans": license_scan_sql(), "op13_phrase_collocations": collocations_sql()}
