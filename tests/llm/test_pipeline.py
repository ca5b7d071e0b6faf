"""The corpus pipeline: each stage on what the one before kept, against plain Python."""

import corpus_pipeline as C
import pytest

from taxaspark.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = C.table(spark, SF, "documents")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(C.written(stage(spark, out[-1], SF), name))
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:4])


def test_each_stage_decides(spark, stages):
    rules = Q.op10_quality_rules(spark, SF)
    assert ids(stages[1]) == ids(rules.where("kept"))
    scores = Q.op9_quality_classifier(spark, SF).where("predicted = 1")
    assert set(ids(stages[2])) == set(ids(stages[1])) & set(ids(scores))
    named = {r.doc_id: r.component_id for r in C.simhash_vptree.near_duplicates(stages[2]).collect()}
    assert ids(stages[3]) == sorted(set(named.values()))
    whole = {r.doc_id: (r.n, r.t) for r in stages[4].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"})
             .withColumnsRenamed({"sum(length)": "n", "max(doc_tokens)": "t"}).collect()}
    assert sorted(whole) == ids(stages[3]) and all(n == t for n, t in whole.values())


def test_clean_documents_are_kept(spark, stages):
    """Documents labelled good that the contract's base rule doesn't reject stay in both filters."""
    good = {r.doc_id for r in C.table(spark, SF, "labels").where("quality = 1").collect()}
    bad = {r.doc_id for r in C.table(spark, SF, "labels").where("quality = 0").collect()}
    base = set(ids(Q.op10_quality_rules(spark, SF).where("not base_failed")))
    kept = set(ids(stages[2]))
    assert len((good & base) - kept) <= 0.01 * len(good)
    assert len(bad & kept) <= 0.1 * len(bad) + 1


def test_run_gives_the_last_stage(spark, stages):
    got = C.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(tuple, stages[4].select("doc_id", "start", "ids_crc32").collect()))


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 14))
