"""Queries against brute-force Python / pandas on random small fixtures."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from taxaspark.operators.pivot import pivot_wide
from taxaspark.plans import queries as Q

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

cell = st.tuples(st.sampled_from(["s1", "s2", "s3", "s4"]), st.sampled_from(["k__A", "k__B", "k__C"]),
                 st.integers(0, 100).map(float))


@SETTINGS
@given(st.lists(cell, min_size=1, max_size=30))
def test_pivot_sum_matches_pandas(spark, rows):
    df = spark.createDataFrame(rows, "sample_id string, clade_name string, relative_abundance double")
    got = {r["sample_id"]: r.asDict() for r in
           pivot_wide(df, "sample_id", "clade_name", "relative_abundance", cell="sum").collect()}
    want = pd.DataFrame(rows, columns=["sample_id", "clade_name", "v"]).pivot_table(
        index="sample_id", columns="clade_name", values="v", aggfunc="sum")
    assert set(got) == set(want.index)
    for sid, row in want.iterrows():
        for clade, v in row.items():
            g = got[sid].get(clade)
            assert (g is None and math.isnan(v)) or g == v


fact = st.tuples(st.sampled_from(["s1", "s2", "s3", "s4", "s5"]), st.sampled_from(["m1", "m2", "m3", "m4"]))
smap = st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3", "s6"]), st.sampled_from(["A", "B", "C"])),
                min_size=1, max_size=6)


@SETTINGS
@given(st.lists(fact, max_size=25), smap)
def test_study_counts_match_left_join_group(spark, facts, maps):
    ab = spark.createDataFrame([(s, m, 1.0) for s, m in facts],
                               "sample_id string, marker_id string, abundance double")
    rows = [(s, f"ERR{s}", f"n{s}", study) for s, study in maps]
    m = spark.createDataFrame(rows, "sample_id string, run_ids string, sample_name string, study_name string")
    got = sorted(tuple(r) for r in Q.study_samples_marker_counts(m, ab, ["A", "B"]).collect())
    # brute force: map LEFT JOIN fact GROUP BY the four map columns, count distinct markers
    groups = {}
    for r in rows:
        if r[3] in ("A", "B"):
            groups.setdefault(r, set()).update(mk for s, mk in facts if s == r[0])
    want = sorted((k[0], k[1], k[2], k[3], len(v)) for k, v in groups.items())
    assert got == want
