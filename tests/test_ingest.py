"""Raw per-sample file ingest: positional header skip, path-derived ids, typing."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from bench_views.frames import write_run
from taxaspark import schemas
from taxaspark.operators.checks import key_check
from taxaspark.operators.joins import join_sample_map
from taxaspark.operators.staging import stage
from taxaspark.sources.lookups import read_accessions, read_sample_map
from taxaspark.sources.raw import scan_ext, scan_src

AB = schemas.MARKER_ABUNDANCE
REL = schemas.MARKER_REL_AB


TAG = schemas.DEFAULT_RUN_TAG


def put(root, sample, ds, text, tag=TAG, raw=False):
    path = os.path.join(root, tag, sample, ds.path_tail)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if raw:  # bytes written as they are (e.g. a file that is not gzip at all)
        with open(path, "wb") as f:
            f.write(text)
        return path
    with gzip.open(path, "wb") as f:
        f.write(text.encode())
    return path


def heads(n, hashed=True):
    return "".join(("#" if hashed else "") + f"header line {i}\n" for i in range(n))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, v) for v in t))


def test_normal_file(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4) + "m1\t1.5\nm2\t2\nm3\t\n")
    df = scan_src(spark, f"{tmp_dir}/{TAG}", AB)
    assert rows(df) == [("s1", "m1", 1.5), ("s1", "m2", 2.0), ("s1", "m3", None)]


def test_header_lines_skipped_by_position(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4, hashed=False) + "#m1\t1\nm2\t2\n")
    df = scan_src(spark, f"{tmp_dir}/{TAG}", AB)
    # plain header lines are skipped, a data line that starts with '#' is kept
    assert rows(df) == [("s1", "#m1", 1.0), ("s1", "m2", 2.0)]


def test_short_file_gives_no_rows(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(2))
    put(tmp_dir, "s2", AB, heads(4))
    put(tmp_dir, "s3", AB, "")
    assert scan_src(spark, f"{tmp_dir}/{TAG}", AB).count() == 0


def test_crlf_and_blank_last_line(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4).replace("\n", "\r\n") + "m1\t1\r\nm2\t2\r\n\r\n")
    assert rows(scan_src(spark, f"{tmp_dir}/{TAG}", AB)) == [("s1", "m1", 1.0), ("s1", "m2", 2.0)]


def test_path_without_run_tag(spark, tmp_dir):
    a = put(tmp_dir, "s1", AB, heads(4) + "m1\t1\n")
    b = put(tmp_dir, "x", AB, heads(4) + "m9\t9\n", tag="other")
    src = scan_src(spark, tmp_dir, AB, paths=[a, b])
    assert rows(src.select("sample_id", "marker_id")) == [(None, "m9"), ("s1", "m1")]  # NULL, not ''

    assert rows(stage(src, AB)) == [("s1", "m1", 1.0)]


def test_lenient_casts_on_rel_ab(spark, tmp_dir):
    body = ("k__A\t1\t50.5\t-\t100\n"
            "k__B\t2\tn/a\t3.5\t1.5\n"
            "k__C\t3\t1.0d\t2f\t0x1F\n"
            "k__D\t4\tinf\t1e3\t-0x10\n")
    put(tmp_dir, "s1", REL, heads(6) + body)
    stg = stage(scan_src(spark, f"{tmp_dir}/{TAG}", REL), REL)
    got = {r.clade_name: (r.relative_abundance, r.coverage, r.estimated_reads) for r in stg.collect()}
    assert got["k__A"] == (50.5, None, 100)
    assert got["k__B"] == (None, 3.5, None)
    assert got["k__C"] == (None, None, 31)
    assert got["k__D"] == (float("inf"), 1000.0, -16)


def test_bad_value_in_strict_column_fails(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4) + "m1\tabc\n")
    with pytest.raises(Exception):
        scan_src(spark, f"{tmp_dir}/{TAG}", AB).collect()


@pytest.mark.parametrize("line", ["m1\n", "m1\t1\textra\n"])
def test_short_and_long_rows_fail(spark, tmp_dir, line):
    put(tmp_dir, "s1", AB, heads(4) + "m0\t1\n" + line)
    with pytest.raises(Exception):
        scan_src(spark, f"{tmp_dir}/{TAG}", AB).collect()


def test_quoted_field(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4) + '"m ""one"""\t1\n')
    assert rows(scan_src(spark, f"{tmp_dir}/{TAG}", AB)) == [("s1", 'm "one"', 1.0)]


def test_ext_layer_keeps_provenance(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4) + "m1\t1\n")
    ext = scan_ext(spark, f"{tmp_dir}/{TAG}", AB)
    r = ext.first()
    assert r.file_path.endswith(f"/{TAG}/s1/metaphlan_markers/marker_abundance.tsv.gz")


@pytest.mark.parametrize("mode", ["wholetext", "lines"])
@pytest.mark.parametrize("listing", ["glob", "recursive"])
def test_sample_filter_prunes_files(spark, tmp_dir, mode, listing):
    put(tmp_dir, "s1", AB, heads(4) + "m1\t1\n")
    # not gzip at all: reading it would fail, so success proves it was skipped
    put(tmp_dir, "s2", AB, b"this is not gzip", raw=True)
    with pytest.raises(Exception):  # unpruned, the broken file is read and fails
        scan_src(spark, f"{tmp_dir}/{TAG}", AB, mode=mode, listing=listing).collect()
    df = scan_src(spark, f"{tmp_dir}/{TAG}", AB, sample_ids=["s1"], mode=mode, listing=listing)
    assert rows(df) == [("s1", "m1", 1.0)]
    if mode == "wholetext":  # a filter written after the scan prunes too (no Python step in between)
        df2 = scan_src(spark, f"{tmp_dir}/{TAG}", AB, listing=listing).where(F.col("sample_id") == "s1")
        assert rows(df2) == [("s1", "m1", 1.0)]


def test_sample_map_csv_quoted_newline_and_duplicates(spark, tmp_dir):
    p = os.path.join(tmp_dir, "map.csv")
    with open(p, "w") as f:
        f.write('sample_id,run_ids,sample_name,study_name\n'
                's1,ERR1,"name\nwith newline",A\n'
                's2,ERR2;ERR3,n2,A\n'
                's2,ERR4,n2b,B\n')
    m = read_sample_map(spark, p)
    assert m.count() == 3
    assert m.where(F.col("sample_id") == "s1").first().sample_name == "name\nwith newline"
    kc = key_check(m, "sample_id", "total_rows", "distinct_sample_ids").first()
    assert (kc.total_rows, kc.distinct_sample_ids) == (3, 2)
    fact = spark.createDataFrame([("s2", "m1", 1.0)], "sample_id string, marker_id string, abundance double")
    assert join_sample_map(fact, m, ["study_name"]).count() == 2  # duplicate key fans out


def test_accessions_dash_is_null_and_types_widened(spark, tmp_dir):
    p = os.path.join(tmp_dir, "acc.tab")
    with open(p, "w") as f:
        f.write("Accession\tStatus\tSpots\tUpdated\n"
                "ERR1\tlive\t10\t2020-01-02 03:04:05\n"
                "ERR2\t-\t-\t-\n")
    df = read_accessions(spark, p)
    types = dict(df.dtypes)
    assert types["Spots"] == "bigint" and types["Status"] == "string"
    assert types["Updated"].startswith("timestamp")
    r = df.where(F.col("Accession") == "ERR2").first()
    assert (r.Status, r.Spots, r.Updated) == (None, None, None)


def test_accessions_short_row_fails(spark, tmp_dir):
    p = os.path.join(tmp_dir, "acc.tab")
    with open(p, "w") as f:
        f.write("Accession\tStatus\tSpots\nERR1\tlive\t10\nERR2\tlive\n")
    with pytest.raises(Exception):
        read_accessions(spark, p).collect()


def test_line_mode_equals_wholetext(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4, hashed=False) + "#m1\t1\r\nm2\t2\n\n")
    put(tmp_dir, "s2", AB, heads(4) + "".join(f"m{i}\t{i}\n" for i in range(5000)))
    put(tmp_dir, "s3", AB, heads(2))
    a = scan_src(spark, f"{tmp_dir}/{TAG}", AB)
    b = scan_src(spark, f"{tmp_dir}/{TAG}", AB, mode="lines")
    assert rows(a) == rows(b) and len(rows(b)) == 5002
    c = scan_src(spark, f"{tmp_dir}/{TAG}", AB, mode="lines", sample_ids=["s1"])
    assert rows(c) == [("s1", "#m1", 1.0), ("s1", "m2", 2.0)]


def test_line_mode_refuses_splittable_files(spark, tmp_dir):
    p = os.path.join(tmp_dir, TAG, "s1", "metaphlan_markers", "marker_abundance.tsv")
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as f:
        f.write("#a\n#b\n#c\n#d\nm1\t1\n")
    with pytest.raises(Exception, match="needs .gz"):
        scan_src(spark, f"{tmp_dir}/{TAG}", AB, paths=p, mode="lines").collect()


def test_raw_round_trip_of_whole_rel_ab_table(spark, tmp_dir):
    """Every sample of the sf0.001 rel_ab view as a raw file, then the staging path."""
    from testdata_paths import SF_SMALL
    from bench_views.frames import RAW_ID_PATTERN, Fixtures, raw_glob, write_raw_dataset
    fx = Fixtures(spark, SF_SMALL)
    root = f"{tmp_dir}/raw"
    write_raw_dataset(fx.raw_rel_ab, root, REL)
    for mode in ("wholetext", "lines"):
        st = stage(scan_src(spark, root, REL, paths=raw_glob(root), id_pattern=RAW_ID_PATTERN, mode=mode), REL)
        assert st.exceptAll(fx.rel_ab).count() == 0 and fx.rel_ab.exceptAll(st).count() == 0


def test_accessions_quoted_newline_needs_multiline(spark, tmp_dir):
    p = os.path.join(tmp_dir, "acc.tab")
    with open(p, "w") as f:
        f.write('Accession\tTitle\tSpots\nERR1\t"two\nlines"\t10\nERR2\tplain\t-\n')
    df = read_accessions(spark, p, multiline=True)
    assert df.count() == 2
    assert df.where(F.col("Accession") == "ERR1").first().Title == "two\nlines"
    with pytest.raises(Exception):  # without multiLine the split row is malformed: fail, never guess
        read_accessions(spark, p, multiline=False).collect()


def test_folder_names_are_decoded(spark, tmp_dir):
    put(tmp_dir, "s 1+x%y", AB, heads(4) + "m1\t1\n")
    df = scan_src(spark, f"{tmp_dir}/{TAG}", AB)
    assert rows(df) == [("s 1+x%y", "m1", 1.0)]
    assert rows(scan_src(spark, f"{tmp_dir}/{TAG}", AB, sample_ids=["s 1+x%y"])) == [("s 1+x%y", "m1", 1.0)]


@pytest.mark.parametrize("mode", ["wholetext", "lines"])
def test_root_with_special_characters(spark, tmp_dir, mode):
    base = os.path.join(tmp_dir, "my data+x")
    put(base, "s1", AB, heads(4) + "m1\t1\n")
    for listing in ("glob", "recursive"):
        df = scan_src(spark, f"{base}/{TAG}", AB, listing=listing, mode=mode)
        assert rows(df) == [("s1", "m1", 1.0)], listing


def test_run_tag_with_a_space(spark, tmp_dir):
    put(tmp_dir, "s1", AB, heads(4) + "m1\t1\n", tag="run 4")
    df = scan_src(spark, f"{tmp_dir}/run 4", AB, run_tag="run 4")
    assert rows(df) == [("s1", "m1", 1.0)]


def test_empty_accession_field_is_empty_text(spark, tmp_dir):
    p = f"{tmp_dir}/acc.tsv"
    with open(p, "w") as f:
        f.write("Accession\tCenter\tSpots\nA1\t\t5\nA2\t-\t-\nA3\tx\t\n")
    from taxaspark.sources.lookups import read_accessions
    got = sorted(map(tuple, read_accessions(spark, p).collect()))
    assert got == [("A1", "", 5), ("A2", None, None), ("A3", "x", None)]
    short = f"{tmp_dir}/short.tsv"
    with open(short, "w") as f:
        f.write("Accession\tCenter\tSpots\nA1\tc\t5\nA2\tc\n")
    from taxaspark.plans.jobs import load_accessions
    with pytest.raises(Exception):
        load_accessions(spark, short, f"{tmp_dir}/wh")


def test_both_read_modes_end_lines_alike(spark, tmp_dir):
    import gzip
    import os

    from taxaspark import schemas
    from taxaspark.sources.raw import scan_src
    ds = schemas.MARKER_ABUNDANCE
    p = os.path.join(tmp_dir, schemas.DEFAULT_RUN_TAG, "s1", ds.path_tail)
    os.makedirs(os.path.dirname(p))
    with gzip.open(p, "wb") as f:
        f.write(b"#1\r\n#2\n#3\r#4\nm1\t1.0\rm2\t2.0\r\nm3\t3.0\n")
    root = f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}"
    both = [sorted(map(tuple, scan_src(spark, root, ds, mode=m).collect())) for m in ("lines", "wholetext")]
    assert both[0] == both[1] == [("s1", "m1", 1.0), ("s1", "m2", 2.0), ("s1", "m3", 3.0)]


@pytest.mark.parametrize("listing", ["recursive", "glob"])
def test_routes_by_size_give_the_same_rows(spark, tmp_dir, listing):
    """Small files in the JVM, large ones line by line; without a large one no Python step."""
    from taxaspark.sources.raw import dataset_lines, dataset_lines_routed, has_large_files
    put(tmp_dir, "small", AB, heads(4) + "m1\t1\r\nm2\t2\n\n")
    put(tmp_dir, "large", AB, heads(4) + "".join(f"m{i * 7919 % 10007}\t{i}\n" for i in range(5000)))
    root = f"{tmp_dir}/{TAG}"
    want = rows(dataset_lines(spark, root, AB, mode="wholetext", listing=listing))
    routed = dataset_lines_routed(spark, root, AB, TAG, None, None, None, listing, bound=1000)
    assert has_large_files(spark, root, AB, listing=listing, bound=1000) and not has_large_files(spark, root, AB, listing=listing)
    assert rows(routed) == want and len(want) == 5002
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan(routed)
    auto = scan_src(spark, root, AB, mode="auto", listing=listing)
    assert "MapInArrow" not in plan(auto) and auto.count() == 5002
    only = dataset_lines_routed(spark, root, AB, TAG, ["small"], None, None, listing, bound=1000)
    assert [r[1] for r in rows(only)] == ["small"] * 2
    # The large file isn't opened by the small files' route: it may even be unreadable.
    put(tmp_dir, "large", AB, b"not gzip" * 1000, raw=True)
    assert _small_route(spark, root, listing) == 2


def _small_route(spark, root, listing):
    from taxaspark.sources.raw import _text
    return _text(spark, root, AB, None, listing, True).where(F.col("size") < 1000).selectExpr("explode(split(value, '\n')) as line").where(
        "line like 'm%'").count()


def _run_of(spark, tmp_dir, samples):
    rows = spark.range(samples * 2).select(F.md5((F.col("id") % samples).cast("string")).alias("sample_id"),
                                           F.concat(F.lit("M"), F.col("id")).alias("marker_id"), F.lit("1").alias("presence"))
    return rows, write_run(rows, f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", schemas.MARKER_PRESENCE)


def test_a_runs_files_are_moved_side_by_side(spark, tmp_dir, monkeypatch):
    """One after the other took most of the time of a run with many samples."""
    import threading

    from taxaspark.sources import snapshots

    class Seen:
        def __init__(self, fs):
            self.fs, self.threads = fs, set()

        def __getattr__(self, name):
            if name == "rename":
                self.threads.add(threading.get_ident())
            return getattr(self.fs, name)

    seen = []

    class Access(snapshots.FileAccess):
        def __init__(self, *args):
            super().__init__(*args)
            self.fs = Seen(self.fs)
            seen.append(self.fs)

    monkeypatch.setattr(snapshots, "FileAccess", Access)
    rows, root = _run_of(spark, tmp_dir, 50)
    assert len(seen[0].threads) > 4
    back = scan_src(spark, root, schemas.MARKER_PRESENCE)
    assert sorted((r.sample_id, r.marker_id) for r in back.collect()) == sorted((r.sample_id, r.marker_id) for r in rows.collect())


def test_many_folders_are_listed_by_few_tasks(spark, tmp_dir, monkeypatch):
    from taxaspark.sources import raw

    monkeypatch.setattr(raw, "LISTING_TASKS", 3)
    rows, root = _run_of(spark, tmp_dir, 50)
    kept = spark.conf.get(raw.LISTING_KEY)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listed", "listed")
    try:
        src = scan_src(spark, root, schemas.MARKER_PRESENCE, mode="auto")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(raw.LISTING_KEY) == kept
    assert src.count() == rows.count()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listed") for s in tracker.getJobInfo(j).stageIds]
    listing = [s.numTasks for s in stages if s and s.name.startswith(("text at", "load at"))]
    assert listing and max(listing) == 3
