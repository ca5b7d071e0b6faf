"""End-to-end jobs on a small hand-made raw tree: P1 twice gives the same tables."""

import gzip
import os

from pyspark.sql import types as T

from taxaspark import schemas
from taxaspark.plans import jobs as P
from taxaspark.session import local_path
from taxaspark.sources.snapshots import folder
from taxaspark.sources.tables import open_table

SAMPLES = ["aa01", "bb02", "cc03"]

BODIES = {
    "marker_abundance": "m1\t1.5\nm2\t2\n",
    "marker_presence": "m1\t1\nm2\t0\n",
    "marker_rel_ab_w_read_stats": "k__Bacteria\t2\t90.0\t-\t100\nk__Bacteria|p__F\t1239\tn/a\t3.5\t7\n",
    "metaphlan_unknown_list": "UNKNOWN\t-1\t10.5\n",
    "metaphlan_viruses_list": ("vg1\tg1\t1000\t0.5\t10\t1.5\t2.0\t1.0\tknown\tk__Viruses\tg1\t\n"),
}


def make_tree(root):
    raw = os.path.join(root, "results", schemas.DEFAULT_RUN_TAG)
    for s in SAMPLES:
        for name, ds in schemas.DATASETS.items():
            p = os.path.join(raw, s, ds.path_tail)
            os.makedirs(os.path.dirname(p), exist_ok=True)
            with gzip.open(p, "wt") as f:
                f.write("".join(f"#h{i}\n" for i in range(ds.skip_rows)) + BODIES[name])
    with open(os.path.join(root, "map.csv"), "w") as f:
        f.write("sample_id,run_ids,sample_name,study_name\n")
        for i, s in enumerate(SAMPLES):
            f.write(f"{s},ERR{i},n{i},{'A' if i < 2 else 'B'}\n")
    with open(os.path.join(root, "acc.tab"), "w") as f:
        f.write("Accession\tStatus\tSpots\nERR0\tlive\t5\nERR1\t-\t-\n")
    return raw


def snapshot(spark, warehouse):
    out = {}
    for ds in schemas.DATASETS.values():
        df = open_table(spark, f"{warehouse}/{ds.stg_table}")
        out[ds.stg_table] = sorted(map(repr, df.collect()))
    return out


def test_full_pipeline_twice(spark, tmp_dir):
    raw = make_tree(tmp_dir)
    cfg = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wh", export_root=f"{tmp_dir}/exp",
                   sample_map_csv=f"{tmp_dir}/map.csv", accessions_path=f"{tmp_dir}/acc.tab",
                   catalog_out=f"{tmp_dir}/catalog")
    r1 = P.run_all(spark, cfg)
    first = snapshot(spark, cfg.warehouse)
    P.run_all(spark, cfg)
    assert snapshot(spark, cfg.warehouse) == first  # full refresh: same rows

    # staged schemas equal the declared ones
    for ds in schemas.DATASETS.values():
        got = open_table(spark, f"{cfg.warehouse}/{ds.stg_table}").schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in ds.staged_schema()]
    rel = open_table(spark, f"{cfg.warehouse}/stg_marker_rel_ab_w_read_stats")
    assert rel.count() == 6 and rel.where("coverage is null").count() == 3
    assert rel.where("relative_abundance is null").count() == 3

    kc = r1["lookups"]["src_sample_id_map"]
    assert (kc.total_rows, kc.distinct_sample_ids) == (3, 3)
    acc = r1["lookups"]["src_sra_accessions"]
    assert (acc.total_rows, acc.unique_accessions) == (2, 2)

    layers = [tuple(r) for r in r1["layers"]]
    assert layers[:3] == [(0, "ext_marker_abundance", 6, None, None), (1, "src_marker_abundance", 6, 0, 6),
                          (2, "stg_marker_abundance", 6, 0, None)]
    assert [x[1] for x in layers] == [f"{k}_{d}" for d in schemas.DATASETS for k in ("ext", "src", "stg")]
    assert not P.failed(r1)

    prof = {r.table_id: r for r in r1["catalog"]["profile"].collect()}
    ext = prof["ext_marker_abundance"]
    raw_bytes = sum(os.path.getsize(os.path.join(raw, s, schemas.MARKER_ABUNDANCE.path_tail)) for s in SAMPLES)
    assert ext.num_rows is None and ext.num_bytes == raw_bytes
    assert prof["stg_marker_abundance"].num_rows == 6
    summary = r1["catalog"]["summary"].first()
    assert summary.total_tables == 17
    assert summary.by_type == {"EXTERNAL": 5, "TABLE": 7, "VIEW": 5}
    assert summary.by_prefix == {"ext_": 5, "src_": 7, "stg_": 5}
    assert os.path.isdir(os.path.join(folder(spark, cfg.catalog_out), "summary"))

    exp = open_table(spark, r1["exports"]["marker_abundance"].path)
    assert exp.columns == ["sample_id", "marker_id", "abundance", "study_name", "sample_name"]
    assert exp.count() == 6


def test_views_are_registered(spark, tmp_dir):
    raw = make_tree(tmp_dir)
    cfg = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wh")
    P.register_src_views(spark, cfg)
    r = spark.sql("select count(*) c, count(distinct sample_id) s from src_marker_presence").first()
    assert (r.c, r.s) == (6, 3)
    r = spark.sql("select file_path, marker_id, abundance from ext_marker_abundance limit 3").collect()
    assert len(r) == 3 and all(x.file_path.endswith("marker_abundance.tsv.gz") for x in r)


def test_recursive_listing_matches_glob(spark, tmp_dir):
    raw = make_tree(tmp_dir)
    # a same-named file one level too deep must not be picked up
    deep = os.path.join(raw, "aa01", "extra", schemas.MARKER_ABUNDANCE.path_tail)
    os.makedirs(os.path.dirname(deep))
    with gzip.open(deep, "wt") as f:
        f.write("not\na\nprofile\n")
    a = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wa", datasets=("marker_abundance",), listing="glob")
    b = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wb", datasets=("marker_abundance",), listing="recursive")
    P.stage_all(spark, a)
    P.stage_all(spark, b)
    ra = sorted(map(tuple, open_table(spark, f"{tmp_dir}/wa/stg_marker_abundance").collect()))
    rb = sorted(map(tuple, open_table(spark, f"{tmp_dir}/wb/stg_marker_abundance").collect()))
    assert ra == rb and len(ra) == 6


def test_range_layout(spark, tmp_dir):
    raw = make_tree(tmp_dir)
    cfg = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wh", layout="range", range_partitions=2,
                   datasets=("marker_abundance",))
    P.stage_all(spark, cfg)
    df = open_table(spark, f"{cfg.warehouse}/stg_marker_abundance")
    assert df.count() == 6
    assert isinstance(df.schema["abundance"].dataType, T.DoubleType)


def test_command_line(spark, tmp_dir, capsys):
    from taxaspark.__main__ import main
    raw = make_tree(tmp_dir)
    common = ["--raw-root", raw, "--warehouse", f"{tmp_dir}/wh"]
    assert main(["load-lookups", *common, "--sample-map-csv", f"{tmp_dir}/map.csv"], spark=spark) == 0
    assert main(["stage", *common, "--datasets", "marker_abundance", "marker_presence"], spark=spark) == 0
    assert main(["export", *common, "--export-root", f"{tmp_dir}/exp",
                 "--datasets", "marker_abundance"], spark=spark) == 0
    assert main(["show-tables", *common, "--datasets", "marker_abundance"], spark=spark) == 0
    assert main(["preview", *common, "--datasets", "marker_abundance"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "distinct_sample_ids" in out and "stg_marker_abundance" in out
    assert "ext_marker_abundance" in out and "file_path" in out
    assert open_table(spark, f"{tmp_dir}/exp/marker_abundance").count() == 6


def test_max_partition_bytes_is_scoped(spark, tmp_dir):
    raw = make_tree(tmp_dir)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cfg = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wh", datasets=("marker_abundance",),
                   max_partition_bytes=1024)
    P.stage_all(spark, cfg)
    assert open_table(spark, f"{tmp_dir}/wh/stg_marker_abundance").count() == 6
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_a_bad_dataset_keeps_its_old_table(spark, tmp_dir, capsys):
    from taxaspark.__main__ import main
    raw = make_tree(tmp_dir)
    cfg = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wh")
    assert not P.failed(P.stage_all(spark, cfg))
    before = snapshot(spark, cfg.warehouse)
    bad = os.path.join(raw, SAMPLES[0], schemas.MARKER_ABUNDANCE.path_tail)
    with gzip.open(bad, "wt") as f:
        f.write("#a\n#b\n#c\n#d\nm1\tnot a number\n")
    out = P.stage_all(spark, cfg)
    assert [t for t, o in out.items() if o.error] == ["stg_marker_abundance"]
    assert snapshot(spark, cfg.warehouse) == before
    assert sorted(n for n in os.listdir(cfg.warehouse)) == sorted(before)  # nothing half written is left
    args = ["stage", "--raw-root", raw, "--warehouse", cfg.warehouse, "--datasets", "marker_abundance", "marker_presence"]
    assert main(args, spark=spark) == 1
    assert "stg_marker_abundance" in capsys.readouterr().err


def test_catalog_goes_on_over_missing_tables(spark, tmp_dir):
    raw = make_tree(tmp_dir)
    cfg = P.Config(raw_root=raw, warehouse=f"{tmp_dir}/wh", datasets=("marker_abundance", "marker_presence"))
    P.stage_dataset(spark, cfg, schemas.MARKER_PRESENCE)
    prof = {r.table_id: r for r in P.refresh_metadata(spark, cfg)["profile"].collect()}
    assert prof["stg_marker_presence"].num_rows == 6 and prof["stg_marker_abundance"].error
    assert prof["src_sra_accessions"].error


def test_the_catalog_lists_each_datasets_files_once(spark, tmp_dir, monkeypatch):
    """Profile and schema of ext_ and src_ come from one scan."""
    from bench_views.frames import write_run

    rows = spark.createDataFrame([("s1", "M1", "1"), ("s2", "M1", "0")], "sample_id string, marker_id string, presence string")
    cfg = P.Config(raw_root=f"{tmp_dir}/{schemas.DEFAULT_RUN_TAG}", warehouse=f"{tmp_dir}/wh", datasets=("marker_presence",))
    write_run(rows, cfg.raw_root, schemas.MARKER_PRESENCE)
    scans, scan = [], P.scan_ext
    monkeypatch.setattr(P, "scan_ext", lambda *a, **k: scans.append(1) or scan(*a, **k))
    made = P.refresh_metadata(spark, cfg)
    fields = {(r.table_id, r.field_name) for r in made["schema"].collect()}
    assert fields == {("ext_marker_presence", "marker_id"), ("ext_marker_presence", "presence"),
                      *(("src_marker_presence", c) for c in ("sample_id", "marker_id", "presence"))}
    assert len(scans) == 1
    P.register_src_views(spark.newSession(), cfg)
    assert len(scans) == 2


def test_tasks_write_a_run_where_it_belongs(spark, tmp_dir):
    """The files hold what Spark's CSV writer writes, under its folder names, and nothing is moved afterwards."""
    from bench_views.frames import CSV, raw_rows, write_raw_dataset, write_run

    ds = schemas.MARKER_PRESENCE
    values = ["M1", "", None, 'a "b"', "tab\there", "two\nlines", " blank ", "#x", "\u00e9"]
    rows = [(s, v, v) for s in ("s1", "a/b%", "", None) for v in values]
    df = spark.createDataFrame(rows * 3000, "sample_id string, marker_id string, presence string")
    root = local_path(write_run(df, f"{tmp_dir}/runs/{schemas.DEFAULT_RUN_TAG}", ds, in_place=True))
    assert os.listdir(os.path.dirname(root)) == [schemas.DEFAULT_RUN_TAG]  # no folder that files were moved from
    by_spark = f"{local_path(tmp_dir)}/by_spark"
    raw_rows(df, ds, None, "header").write.partitionBy("sample_id").options(**CSV).option("compression", "gzip").csv(by_spark)
    folders = {n[len("sample_id="):] for n in os.listdir(by_spark) if n.startswith("sample_id=")}
    assert set(os.listdir(root)) == folders == {"s1", "a%2Fb%25", "__HIVE_DEFAULT_PARTITION__"}

    def lines(folder, files):
        return sorted(b"".join(gzip.open(os.path.join(folder, f)).read() for f in files).split(b"\n"))

    for name in folders:
        theirs = f"{by_spark}/sample_id={name}"
        mine = os.path.join(root, name, os.path.dirname(ds.path_tail))
        assert os.listdir(mine) == [os.path.basename(ds.path_tail)]
        assert lines(mine, os.listdir(mine)) == lines(theirs, [f for f in os.listdir(theirs) if f.startswith("part-")])
    top = local_path(write_raw_dataset(df.where("sample_id = 's1'"), f"{tmp_dir}/raw", ds, in_place=True))
    with gzip.open(f"{top}/sample_id=s1/part-0.csv.gz", "rt") as f:
        assert f.readline() == f'"#header -{ds.skip_rows}"\t\n'


def test_a_listing_has_four_tasks_a_core_at_most(spark):
    from taxaspark.sources import raw

    with raw.few_listing_tasks(spark):
        assert int(spark.conf.get(raw.LISTING_KEY)) <= 4 * spark.sparkContext.defaultParallelism


def test_two_runs_are_listed_once_and_their_names_cut_without_a_regex(spark, monkeypatch):
    import __spark_entry__ as e

    scans, scan = [], e.scan_ext
    monkeypatch.setattr(e, "scan_ext", lambda *a, **k: scans.append(1) or scan(*a, **k))
    monkeypatch.setattr(e, "scan_src", lambda *a, **k: scans.append(1), raising=False)
    plan = e.a4(spark, e.SF_SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert len(scans) == 1 and "substring_index" in plan and "]+)$" not in plan


def test_raw_files_get_their_header_without_another_pass(spark, tmp_dir):
    """The input is computed once; each file starts with the header lines, as Spark's writer would put them."""
    from pyspark.sql import functions as F

    from bench_views.frames import write_run

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def sample(i):
        seen.add(1)
        return f"s{i % 5}"

    ds = schemas.MARKER_PRESENCE
    df = spark.range(0, 200, 1, 4).select(sample("id").alias("sample_id"), F.concat(F.lit("M"), F.col("id")).alias("marker_id"),
                                          (F.col("id") % 2).alias("presence"))
    write_run(df, tmp_dir, ds, in_place=True)
    assert seen.value == 200
    for i in range(5):
        with gzip.open(f"{tmp_dir}/s{i}/{ds.path_tail}", "rt") as f:
            lines = f.read().splitlines()
        heads = [f"header -{k}\t" for k in range(ds.skip_rows, 1, -1)] + ['"marker_id\tpresence"\t']
        assert lines[:ds.skip_rows] == heads
        assert sorted(lines[ds.skip_rows:]) == sorted(f"M{k}\t{k % 2}" for k in range(i, 200, 5))


def test_catalog_tables_are_staged_side_by_side(spark, monkeypatch):
    from threading import Barrier

    import __spark_entry__ as E

    together = Barrier(len(schemas.DATASETS), timeout=20)
    monkeypatch.setattr(E, "_WAREHOUSES", {})
    write = E.write_table
    monkeypatch.setattr(E, "write_table", lambda df, path: (together.wait(), write(df, path)))
    assert len(E._fixture_catalog(spark, "/root/testdata/sf0.001")) == len(schemas.DATASETS) + 1


ODD_SAMPLES = ["aa01", "b [1]", "c{x,y}", "d*?", "e+%20", "_gone", ".gone", "k=v", "_k=v"]


def odd_tree(root, ds=schemas.MARKER_PRESENCE):
    raw = os.path.join(root, schemas.DEFAULT_RUN_TAG)
    for i, s in enumerate(ODD_SAMPLES):
        p = os.path.join(raw, s, ds.path_tail)
        os.makedirs(os.path.dirname(p))
        with gzip.open(p, "wt") as f:
            f.write("#\n" * ds.skip_rows + f"m{i}\t{i}\nm\t1\n")
    with open(os.path.join(raw, "a file"), "w") as f:
        f.write("not a folder")
    os.symlink(os.path.join(raw, "nowhere"), os.path.join(raw, "a link"))
    return raw


def test_many_folders_are_listed_and_staged_in_groups(spark, tmp_dir, monkeypatch):
    """The driver never knows the files of more than a group; the table, its counts and its parts are those of one listing."""
    from taxaspark.session import scratch_path
    from taxaspark.sources import raw
    from taxaspark.sources.snapshots import latest

    ds = schemas.MARKER_PRESENCE
    root = odd_tree(local_path(tmp_dir))
    one, many = (P.Config(raw_root=root, warehouse=f"{tmp_dir}/{w}", datasets=(ds.name,)) for w in ("one", "many"))
    P.stage_all(spark, one)
    listed, read = [], raw._read_text
    monkeypatch.setattr(raw, "_read_text", lambda *a, **k: listed.append(df := read(*a, **k)) or df)
    monkeypatch.setattr(raw, "FOLDERS", 2)
    scratch = os.path.dirname(local_path(scratch_path(spark, "x")))
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    kept = {k: spark.conf.get(k) for k in (raw.LISTING_KEY, raw.KEPT_KEY, raw.OPEN_KEY)}
    for mode in ("auto", "lines", "wholetext"):
        many.read_mode = mode
        assert not P.failed(P.stage_all(spark, many))
        assert len(listed) >= 4 and max(len(df.inputFiles()) for df in listed) <= 2
        listed.clear()
        tables = [f"{c.warehouse}/{ds.stg_table}" for c in (one, many)]
        rows = [sorted(map(tuple, open_table(spark, t).collect())) for t in tables]
        assert rows[0] == rows[1] and len(rows[0]) == 14 and {r[0] for r in rows[0]} == {*ODD_SAMPLES} - {"_gone", ".gone"}
        made = [latest(spark, t) for t in tables]
        assert made[0].counts == made[1].counts == {"rows": 14, "keyed": 14}
    assert {k: spark.conf.get(k) for k in kept} == kept
    assert set(os.listdir(scratch)) == before  # no row is left beside the table
    with gzip.open(os.path.join(root, "k=v", ds.path_tail), "wt") as f:
        f.write("#\n" * ds.skip_rows + "m\tnot a number\n")
    assert P.failed(P.stage_all(spark, many))
    assert sorted(map(tuple, open_table(spark, tables[1]).collect())) == rows[0]
    assert set(os.listdir(scratch)) == before
    many.raw_root = f"{tmp_dir}/nowhere"
    assert "PATH_NOT_FOUND" in P.failed(P.stage_all(spark, many))[0]


def test_the_catalog_never_lists_more_than_a_group(spark, tmp_dir, monkeypatch):
    from taxaspark.operators import catalog
    from taxaspark.sources import raw

    cfg = P.Config(raw_root=odd_tree(local_path(tmp_dir)), warehouse=f"{tmp_dir}/wh", datasets=("marker_presence",))
    P.stage_all(spark, cfg)
    keys = ("table_id", "num_fields", "num_rows", "num_bytes", "error")

    def profile(count_external):
        entries = P.catalog_entries(spark, cfg)
        made = catalog.table_profile(spark, entries, count_external)
        fields = sorted(map(tuple, catalog.schema_catalog(spark, entries).collect()))
        return sorted(map(str, made.where("table_id like '%marker_presence'").select(*keys).collect())), fields

    want = [profile(c) for c in (False, True)]
    assert any("num_rows=14" in r and "ext_" in r for r in want[1][0])
    scans, scan = [], P.scan_ext
    monkeypatch.setattr(P, "scan_ext", lambda *a, **k: scans.append(k["folders"]) or scan(*a, **k))
    loads, paths = [], catalog.folder_paths
    monkeypatch.setattr(catalog, "folder_paths", lambda *a: loads.append(found := paths(*a)) or found)
    monkeypatch.setattr(raw, "FOLDERS", 2)
    assert profile(False) == want[0]
    assert [len(f) for f in scans] == [1]  # for the fields of both layers
    assert loads and max(map(len, loads)) <= 2
    assert profile(True) == want[1] and max(map(len, scans)) <= 2


def test_listings_are_forgotten_with_their_readers(spark, tmp_dir):
    """Spark's shared cache keeps 250 MB of the driver's memory for entries that no other reader looks at."""
    from taxaspark.sources import raw

    with raw.few_listing_tasks(spark):
        assert spark.conf.get(raw.KEPT_KEY) == "0"
    assert spark.conf.get(raw.KEPT_KEY) != "0"


def test_names_below_a_folder_that_only_hadoop_reads(spark, tmp_dir, monkeypatch):
    from taxaspark.sources import snapshots

    os.makedirs(f"{local_path(tmp_dir)}/a, b")
    names = ["a, b", *[f"s{i}, /x".replace("/", "_") for i in range(7)]]
    for n in names[1:]:
        os.makedirs(f"{local_path(tmp_dir)}/{n}")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.names.link./in", f"file://{local_path(tmp_dir)}")
    monkeypatch.setattr(snapshots, "NAMES", 3)
    for path in ("viewfs://names/in", f"file://{local_path(tmp_dir)}", tmp_dir):
        files = snapshots.FileAccess(spark, path)
        assert files.below(path) == sorted(names) and files.below(f"{path}/nowhere") == []


def test_the_whole_job_in_groups_gives_what_one_listing_gives(spark, tmp_dir, monkeypatch):
    from taxaspark.sources import raw

    root, names = make_tree(tmp_dir), ("marker_abundance", "metaphlan_viruses_list")

    def run(to):
        cfg = P.Config(raw_root=root, warehouse=f"{tmp_dir}/{to}/wh", export_root=f"{tmp_dir}/{to}/exp", catalog_out=f"{tmp_dir}/{to}/catalog",
                       sample_map_csv=f"{tmp_dir}/map.csv", accessions_path=f"{tmp_dir}/acc.tab",
                       datasets=names)
        made = P.run_all(spark, cfg)
        assert not P.failed(made)
        keys = ("table_id", "table_type", "num_fields", "num_rows")
        profile = sorted(map(tuple, made["catalog"]["profile"].select(*keys, "error").collect()), key=str)
        sizes = sorted(map(tuple, made["catalog"]["profile"].where("table_type = 'EXTERNAL'").select("table_id", "num_bytes").collect()))
        exports = {n: sorted(map(str, open_table(spark, o.path).collect())) for n, o in made["exports"].items()}
        tables = {n: sorted(map(str, open_table(spark, o.path).collect())) for n, o in made["staged"].items()}
        return [*map(tuple, made["layers"])], profile, sizes, exports, tables

    want, listed, read = run("one"), [], raw._read_text
    monkeypatch.setattr(raw, "_read_text", lambda *a, **k: listed.append(df := read(*a, **k)) or df)
    monkeypatch.setattr(raw, "FOLDERS", 1)
    assert run("many") == want
    assert len(listed) >= len(SAMPLES) * len(names) and max(len(df.inputFiles()) for df in listed) == 1
