"""Write docs/PLANS.md: physical plans of the headline queries over staged tables.

Usage: python tools/plan_report.py [sf_dir]
The staged tables and the map are written once (as the pipeline would), then
each query is planned against the Parquet tables, so the plans are those a
production run gets.  Scale notes are kept next to each plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from taxaspark import schemas  # noqa: E402
from taxaspark.operators.staging import cluster, stage, write_table  # noqa: E402
from taxaspark.sources.tables import open_table  # noqa: E402
from taxaspark.plans import queries as Q  # noqa: E402
from taxaspark.plans.exports import export_frame  # noqa: E402
from bench_views.frames import Fixtures, write_run  # noqa: E402
from taxaspark.session import get_session, scratch_path  # noqa: E402
from taxaspark.sources.raw import scan_src  # noqa: E402

NOTES = {
    "J staging (raw files → stg)": (
        "Line scan → line numbers by Arrow batch → header skip → from_csv → casts → one range exchange on the sample id "
        "(with a row hash and the task behind it) → sort → write. Files are never held whole."),
    "Q1 point lookup": (
        "EqualTo(sample_id) pushed into the Parquet scan: row groups are skipped by min/max, dictionary "
        "and (where written) bloom filter on the clustered key."),
    "Q2 top markers by mean": (
        "Two-level aggregate for the single count(distinct): partial agg on (marker, sample) before the "
        "first exchange, then on marker; no Expand. A hot marker or sample costs one partial row per task. "
        "TakeOrderedAndProject keeps k rows per task."),
    "Q6 presence comparison": (
        "The sample set (a study's samples) is a left semi join, broadcast by size; the aggregate "
        "is partial before the exchange. string_agg groups are bounded by the chosen samples."),
    "Q7 profiles with study": (
        "Study filter on the map before the join (pushed to its scan); the filtered map is broadcast by "
        "size. LIKE 'k__%' has '_' wildcards, so it stays a filter in the scan stage rather than "
        "a Parquet prefix filter. Top-k per task, then merged."),
    "Q8 study marker counts": (
        "Fact side cut by a semi join on the studies' samples and reduced to one row per sample "
        "(two-level distinct count) before the outer join with the map: no fan-out is shuffled."),
    "Q12 kingdom composition": (
        "The first n ids are fetched (bounded by n) and pushed to the scan as In(...): only the row groups "
        "holding them are read."),
    "X1 export": (
        "Map join, then one range exchange on (study, sample name, marker, sample id, row hash, task) and a sort of "
        "the first three: part files are globally ordered; shared leading keys and identical copies still "
        "spread over ranges."),
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue().strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    fx = Fixtures(spark, sf)
    wh = scratch_path(spark, "plan_warehouse")
    for name, ds in schemas.DATASETS.items():
        write_table(fx.staged(name), f"{wh}/{ds.stg_table}")
    fx.sample_map.write.parquet(f"{wh}/{schemas.SAMPLE_MAP_TABLE}")
    t = {n: open_table(spark, f"{wh}/{n}") for n in
         [ds.stg_table for ds in schemas.DATASETS.values()] + [schemas.SAMPLE_MAP_TABLE]}
    ab, pres, rel = t["stg_marker_abundance"], t["stg_marker_presence"], t["stg_marker_rel_ab_w_read_stats"]
    smap = t[schemas.SAMPLE_MAP_TABLE]
    study = smap.where("study_name = '5-LOW'").select("sample_id")

    raw = write_run(fx.by_supplier("marker_abundance"), f"{scratch_path(spark, 'plan_raw')}/{schemas.DEFAULT_RUN_TAG}", schemas.MARKER_ABUNDANCE)
    staging = cluster(stage(scan_src(spark, raw, schemas.MARKER_ABUNDANCE, mode="lines"), schemas.MARKER_ABUNDANCE))

    plans = {
        "J staging (raw files → stg)": staging,
        "Q1 point lookup": Q.sample_rows_for(ab, "c4ca4238a0b923820dcc509a6f75849b"),
        "Q2 top markers by mean": Q.top_markers_by_mean(ab),
        "Q6 presence comparison": Q.marker_presence_comparison(pres, study),
        "Q7 profiles with study": Q.profiles_with_study(rel, smap, "5-LOW"),
        "Q8 study marker counts": Q.study_samples_marker_counts(smap, ab, ["5-LOW", "3-MEDIUM"]),
        "Q12 kingdom composition": Q.kingdom_composition_long(rel, 10),
        "X1 export": export_frame(ab, smap, "marker_abundance"),
    }
    out = ["# Physical plans of the headline queries",
           "",
           "Generated by `tools/plan_report.py` over staged Parquet tables (sf0.01, local[8]).",
           "File paths are shortened. AQE re-plans at runtime (coalescing, skew splits).",
           ""]
    for title, df in plans.items():
        text = plan_text(df)
        text = re.sub(r"file:/[^ ,\]]*/(?=(?:stg|src)_)|file:/[^ ,\]]*/(?=" + schemas.DEFAULT_RUN_TAG + ")", "", text)
        out += [f"## {title}", "", NOTES[title], "", "```", text, "```", ""]
    os.makedirs("docs", exist_ok=True)
    with open("docs/PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
