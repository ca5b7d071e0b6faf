"""

``entry(spark)`` runs the flagship query (top markers by mean abundance) on
sf0.001.  ``queries()`` maps every implemented job / query / operator to a
callable ``(spark, sf_dir) -> DataFrame`` over profile-shaped views of the
benchmark tables (``bench_views.frames``); ``oracle_sql()`` gives the
same computation as DuckDB SQL over the same tables.

Keys that write (J*, X*, K*, P2) write below the session's
``spark.checkpoint.dir`` and return the written table read back.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

# The package sits next to this file; make it importable however this file is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bench_views import frames
from bench_views.frames import ODD_NUMBERS, RAW_ID_PATTERN, Fixtures, raw_glob
from bench_views.sql import with_views
from taxaspark import schemas
from taxaspark.functions.columns import (
    lenient_double, lenient_long, null_sentinel, ordered_string_agg, sample_id_from_path,
)
from taxaspark.operators.aggregates import count_if
from taxaspark.operators.catalog import (
    TABLE, TableEntry, catalog_summary, schema_catalog, table_listing, table_profile,
)
from taxaspark.operators.checks import key_check, layer_counts, preview
from taxaspark.operators.joins import join_sample_map
from taxaspark.operators.pivot import pivot_wide
from taxaspark.operators import companions
from taxaspark.operators.companions import open_companion
from taxaspark.operators.sampling import HASH_DIGITS, key_bound, sample_blocks
from taxaspark.operators.staging import stage, staged_rows, write_table
from taxaspark.plans import queries as Q
from taxaspark.plans.exports import export_csv, export_dataset
from taxaspark.plans import jobs
from taxaspark.session import scratch_path
from taxaspark.sources.raw import scan_ext, scan_src, src_of
from taxaspark.sources.snapshots import folder, latest
from taxaspark.sources.tables import open_table, read_table

try:  # the training-data operators can be left out of an installation
    import corpus_pipeline
    from taxaspark.llm import queries as llm_queries
except ModuleNotFoundError as exc:
    if exc.name not in ("corpus_pipeline", "taxaspark.llm"):  # something else is missing
        raise
    corpus_pipeline = llm_queries = None

# The scratch folder is shared with the tasks.
write_run = partial(frames.write_run, in_place=True)
write_raw_dataset = partial(frames.write_raw_dataset, in_place=True)

SF_SMOKE = "/root/testdata/sf0.001"

# Fixed query parameters (FIXTURES.md §3).
POINT_SAMPLE = hashlib.md5(b"1").hexdigest()
CHOSEN_SAMPLES = [hashlib.md5(k.encode()).hexdigest() for k in ("1", "2", "3", "7")]
STUDY = "5-LOW"
STUDIES = ["5-LOW", "3-MEDIUM"]
TAXON_LIKE = "%widget%"
KINGDOMS = [f"k__{t}" for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]

MAP_COLS = ["sample_id", "run_ids", "sample_name", "study_name"]


def _sql_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------- queries

def q1(spark, sf):
    return Q.sample_rows_for(Fixtures(spark, sf).staged("marker_abundance"), POINT_SAMPLE)


def q2(spark, sf):
    return Q.top_markers_by_mean(Fixtures(spark, sf).staged("marker_abundance"), k=20)


def q2b(spark, sf):
    return Q.top_markers_by_samples(Fixtures(spark, sf).staged("marker_abundance"), k=10)


def q3(spark, sf):
    return Q.sample_profiles(Fixtures(spark, sf).rel_ab, CHOSEN_SAMPLES)


def q4(spark, sf):
    return Q.samples_with_taxon(Fixtures(spark, sf).rel_ab, TAXON_LIKE, 10.0, k=100)


def q5(spark, sf):
    return Q.viral_summary(Fixtures(spark, sf).staged("metaphlan_viruses_list"), 5, k=50)


def q6(spark, sf):
    fx = Fixtures(spark, sf)
    study_samples = fx.sample_map.where(F.col("study_name") == STUDY).select("sample_id")
    return Q.marker_presence_comparison(fx.staged("marker_presence"), study_samples)


def q7(spark, sf):
    fx = Fixtures(spark, sf)
    return Q.profiles_with_study(fx.rel_ab, fx.sample_map, STUDY)


def q8(spark, sf):
    fx = Fixtures(spark, sf)
    return Q.study_samples_marker_counts(fx.sample_map, fx.staged("marker_abundance"), STUDIES)


def q9(spark, sf):
    return Q.marker_count_per_sample(Fixtures(spark, sf).staged("marker_abundance"), 10)


def q10(spark, sf):
    """The estimate next to the exact count, and whether it lies within three standard errors."""
    stg = Fixtures(spark, sf).staged("marker_abundance")
    both = Q.approx_distinct_samples(stg).withColumn("i", F.lit(0)).unionByName(
        stg.agg(F.count_distinct("sample_id").alias("exact_samples")).withColumn("i", F.lit(0)), allowMissingColumns=True)
    one = both.groupBy("i").agg(F.max("approx_samples").alias("approx"), F.max("exact_samples").alias("exact_samples"))
    return one.select("exact_samples", (F.abs(F.col("approx") - F.col("exact_samples")) <= 0.15 * F.col("exact_samples"))
                      .alias("within_bound"))


def q11(spark, sf):
    """A 1 % row sample: no row that the table doesn't have, and a size within five standard deviations."""
    stg = Fixtures(spark, sf).staged("marker_abundance")
    keys = stg.columns
    sample = Q.sampled_scan(stg, 1.0, seed=42, limit=None).groupBy(*keys).agg(F.count("*").alias("taken"))
    both = stg.groupBy(*keys).agg(F.count("*").alias("there")).join(sample, keys, "full")
    n, k = F.sum("there"), F.sum("taken")
    return both.agg(n.alias("total_rows"), (F.sum(F.when(F.col("taken") > F.coalesce("there", F.lit(0)), 1).otherwise(0)) == 0).alias("is_subset"),
                    (F.abs(k - 0.01 * n) <= 5 * F.sqrt(0.01 * 0.99 * n)).alias("within_5_sigma"))


def _published(spark, sf, name, companions=None, **how):
    """A staged table published with its companions; its path."""
    path = scratch_path(spark, schemas.DATASETS[name].stg_table)
    write_table(Fixtures(spark, sf).staged(name), path, companions=companions, **how)
    return path


def _bitmap_counts(spark, path):
    codes = open_companion(spark, path, "sample_codes")
    return open_table(spark, path), companions.sample_counts(companions.bitmaps(open_table(spark, path), codes, "marker_id"), "marker_id")


def q2_bitmaps(spark, sf):
    """Q2 with the sample counts taken from bitmaps of sample codes."""
    table, counts = _bitmap_counts(spark, _published(spark, sf, "marker_abundance", {"sample_codes": companions.sample_codes}))
    return Q.top_markers_by_mean(table, k=20, counts=counts)


def q2b_bitmaps(spark, sf):
    table, counts = _bitmap_counts(spark, _published(spark, sf, "marker_abundance", {"sample_codes": companions.sample_codes}))
    return Q.top_markers_by_samples(table, k=10, counts=counts)


def q4_names(spark, sf):
    """Q4 with the pattern resolved in the table's names."""
    path = _published(spark, sf, "marker_rel_ab_w_read_stats", {"names_clade_name": companions.names("clade_name")})
    return Q.samples_with_taxon(open_table(spark, path), TAXON_LIKE, 10.0, k=100, names=open_companion(spark, path, "names_clade_name"))


def q12_names(spark, sf):
    path = _published(spark, sf, "marker_rel_ab_w_read_stats", {"names_clade_name": companions.names("clade_name")})
    return Q.kingdom_composition_long(open_table(spark, path), 10, names=open_companion(spark, path, "names_clade_name"))


def q10_sketches(spark, sf):
    """Distinct samples and markers over two tables from their stored sketches alone, next to the exact counts."""
    names = ("marker_abundance", "marker_presence")
    paths = [_published(spark, sf, n, companions.for_dataset(schemas.DATASETS[n])) for n in names]
    kept = [open_companion(spark, p, "sketches") for p in paths]
    rows = open_table(spark, paths[0]).select("sample_id", "marker_id").union(open_table(spark, paths[1]).select("sample_id", "marker_id"))
    out = []
    for column in ("sample_id", "marker_id"):
        both = companions.estimated_distinct(kept, column, "estimate").unionByName(
            rows.agg(F.count_distinct(column).alias("exact")), allowMissingColumns=True)
        one = both.agg(F.max("estimate").alias("estimate"), F.max("exact").alias("exact"))
        out.append(one.select(F.lit(column).alias("column_name"), "exact",
                              (F.abs(F.col("estimate") - F.col("exact")) <= 0.03 * F.col("exact")).alias("within_bound")))
    return out[0].union(out[1])


def g7_blocks(spark, sf):
    """A 25 % block sample: only rows of the table, a size within five standard deviations, and other files unread."""
    path = _published(spark, sf, "marker_abundance", partitions=64)
    table = open_table(spark, path)
    sample = sample_blocks(table, 25.0, seed=7)
    files = {f["name"]: f["rows"] for f in latest(spark, path).files}
    spread = sum(n * n for n in files.values())
    keys = table.columns
    taken = sample.groupBy(*keys).agg(F.count("*").alias("taken"))
    both = table.groupBy(*keys).agg(F.count("*").alias("there")).join(taken, keys, "full")
    n, k = F.sum("there"), F.sum(F.coalesce("taken", F.lit(0)))
    subset = F.sum(F.when(F.col("taken") > F.coalesce("there", F.lit(0)), 1).otherwise(0)) == 0
    return both.agg(n.alias("total_rows"), subset.alias("is_subset"),
                    (F.abs(k - 0.25 * n) <= 5 * F.sqrt(F.lit(0.25 * 0.75 * spread))).alias("within_5_sigma"))


def g5(spark, sf):
    """Limit without an order: as many rows as asked for, all from the table."""
    stg = Fixtures(spark, sf).staged("marker_abundance")
    return stg.limit(1000).join(stg.select("marker_id").distinct(), "marker_id", "left_semi").agg(F.count("*").alias("limited_rows"))


def q11b(spark, sf):
    return Q.sampled_scan(Fixtures(spark, sf).staged("marker_abundance"), 1.0, by_sample=True, limit=None)


def q12(spark, sf):
    return Q.kingdom_composition_long(Fixtures(spark, sf).rel_ab, 10)


def q13(spark, sf):
    return Q.kingdom_composition_wide(Fixtures(spark, sf).rel_ab, 10, cell="sum", kingdoms=KINGDOMS)


def q6_long(spark, sf):
    """The presence comparison in long form: one row for each marker present in a study's sample."""
    fx = Fixtures(spark, sf)
    study = fx.sample_map.where(F.col("study_name") == STUDY)
    return Q.restrict_samples(fx.staged("marker_presence").where("presence = 1"), study).select("marker_id", "sample_id")


# ---------------------------------------------------------------- staging / loads

def _staged_roundtrip(spark, sf, name):
    fx = Fixtures(spark, sf)
    ds = schemas.DATASETS[name]
    path = scratch_path(spark, ds.stg_table)
    write_table(fx.staged(name), path)
    return open_table(spark, path)


def j1(spark, sf):
    return _staged_roundtrip(spark, sf, "marker_abundance")


def j2(spark, sf):
    return _staged_roundtrip(spark, sf, "marker_presence")


def j3(spark, sf):
    return _staged_roundtrip(spark, sf, "marker_rel_ab_w_read_stats")


def j4(spark, sf):
    return _staged_roundtrip(spark, sf, "metaphlan_unknown_list")


def j5(spark, sf):
    return _staged_roundtrip(spark, sf, "metaphlan_viruses_list")


def _raw_stage_roundtrip(spark, sf, name, mode="wholetext"):
    """Raw per-sample gz TSVs (with header lines) → positional scan → stage → table."""
    fx = Fixtures(spark, sf)
    ds = schemas.DATASETS[name]
    raw = {"metaphlan_unknown_list": fx.raw_unknown, "metaphlan_viruses_list": fx.viruses}[name]
    root = scratch_path(spark, f"raw_{name}")
    write_raw_dataset(raw, root, ds)
    src = scan_src(spark, root, ds, paths=raw_glob(root), id_pattern=RAW_ID_PATTERN, mode=mode)
    out = scratch_path(spark, ds.stg_table)
    write_table(stage(src, ds), out)
    return open_table(spark, out)


def j4_raw(spark, sf):
    return _raw_stage_roundtrip(spark, sf, "metaphlan_unknown_list")


def j5_raw(spark, sf):
    return _raw_stage_roundtrip(spark, sf, "metaphlan_viruses_list")


def j5_raw_lines(spark, sf):
    """The same raw round trip read in line mode (Arrow line numbering per file)."""
    return _raw_stage_roundtrip(spark, sf, "metaphlan_viruses_list", mode="lines")


def _run_roundtrip(spark, sf, name):
    """A raw run of all rows, one gz file a sample → recursive listing → stage → table."""
    ds = schemas.DATASETS[name]
    root = f"{scratch_path(spark, 'run')}/{schemas.DEFAULT_RUN_TAG}"
    write_run(Fixtures(spark, sf).by_supplier(name), root, ds)
    cfg = jobs.Config(raw_root=root, warehouse=scratch_path(spark, "run_warehouse"))
    return open_table(spark, jobs.stage_dataset(spark, cfg, ds))


def j1_run(spark, sf):
    return _run_roundtrip(spark, sf, "marker_abundance")


def j2_run(spark, sf):
    return _run_roundtrip(spark, sf, "marker_presence")


def j3_run(spark, sf):
    return _run_roundtrip(spark, sf, "marker_rel_ab_w_read_stats")


def _two_runs(spark, sf, name):
    """(ext, src) of files under the run tag (even suppliers) and of files under another folder."""
    ds = schemas.DATASETS[name]
    top = scratch_path(spark, "runs")
    rows = Fixtures(spark, sf).by_supplier(name)
    even = Fixtures(spark, sf).table("supplier").where("s_suppkey % 2 = 0").select(F.md5(F.col("s_suppkey").cast("string")).alias("sample_id"))
    globs = []
    for folder, how in ((schemas.DEFAULT_RUN_TAG, "left_semi"), ("other_run", "left_anti")):
        globs.append(f"{write_run(rows.join(even, 'sample_id', how), f'{top}/{folder}', ds)}/*/{ds.path_tail}")
    ext = scan_ext(spark, top, ds, paths=globs, mode="lines")  # listed once for both layers
    return ext, src_of(ext, ds)


def d1(spark, sf):
    """Staging drops rows whose file lies outside the run tag (no sample id)."""
    _, src = _two_runs(spark, sf, "marker_presence")
    return stage(src, schemas.MARKER_PRESENCE)


def a4(spark, sf):
    """Rows of each raw file, by the file pseudo-column."""
    ext, _ = _two_runs(spark, sf, "marker_presence")
    file = F.substring_index("file_path", "/", -4)  # a regex that looks for the end takes time with the square of a name's length
    return ext.groupBy(file.alias("file")).agg(F.count("*").alias("num_rows"))


def p2(spark, sf):
    """A refresh in which one dataset's file is bad: it keeps its old table, the others are refreshed."""
    fx = Fixtures(spark, sf)
    top = scratch_path(spark, "refresh")
    cfg = jobs.Config(raw_root=f"{top}/{schemas.DEFAULT_RUN_TAG}", warehouse=f"{top}/warehouse",
                      datasets=("marker_abundance", "marker_presence"))
    abundance = fx.by_supplier("marker_abundance")
    write_run(abundance, cfg.raw_root, schemas.MARKER_ABUNDANCE)
    write_run(fx.by_supplier("marker_presence").where("presence = 1"), cfg.raw_root, schemas.MARKER_PRESENCE)
    jobs.stage_all(spark, cfg)
    cfg.raw_root = f"{top}/again/{schemas.DEFAULT_RUN_TAG}"
    write_run(abundance.withColumn("abundance", F.lit("not a number")), cfg.raw_root, schemas.MARKER_ABUNDANCE)
    write_run(fx.by_supplier("marker_presence"), cfg.raw_root, schemas.MARKER_PRESENCE)
    out = jobs.stage_all(spark, cfg)
    parts = [open_table(spark, o.path).agg(F.count("*").alias("num_rows")).select(
        F.lit(o.table).alias("table_id"), F.lit(o.error is None).alias("refreshed"), "num_rows") for o in out.values()]
    return parts[0].union(parts[1])


def j6(spark, sf):
    """Sample map written as CSV, loaded back by the lookup job."""
    csv = scratch_path(spark, "sample_id_map_csv")
    Fixtures(spark, sf).sample_map.write.option("header", True).option("escape", '"').csv(csv)
    warehouse = scratch_path(spark, "map")
    jobs.load_sample_map(spark, csv, warehouse)
    return read_table(spark, warehouse, schemas.SAMPLE_MAP_TABLE)


def j7(spark, sf):
    """Accession dump written as TSV ('-' for NULL), inferred, loaded to Parquet."""
    tsv = scratch_path(spark, "sra_accessions_tsv")
    (Fixtures(spark, sf).raw_accessions.write.option("header", True).option("sep", "\t")
        .option("escape", '"').option("emptyValue", "").csv(tsv))
    warehouse = scratch_path(spark, "accessions")
    jobs.load_accessions(spark, tsv, warehouse)
    return read_table(spark, warehouse, schemas.ACCESSIONS_TABLE)


def j7_multiline(spark, sf):
    """A dump whose fields hold line ends (LF and CRLF), doubled quotes and separators, in blocks of 16 KB."""
    tsv = scratch_path(spark, "sra_accessions_tsv")
    k = F.col("Spots").cast("int") % 7
    texts = (F.when(k == 0, F.concat(F.lit('two\nlines "'), F.col("Spots"), F.lit('"'))).when(k == 1, F.lit('crlf\r\nand\ttab\n\n'))
             .when(k == 2, F.lit('"\n"')).otherwise(F.col("Center")))
    rows = Fixtures(spark, sf).raw_accessions.withColumn("Center", texts).coalesce(1)
    kept = {"header": True, "sep": "\t", "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**kept).csv(tsv)
    warehouse = scratch_path(spark, "accessions")
    jobs.load_accessions(spark, tsv, warehouse, block_bytes=16 * 1024)
    return read_table(spark, warehouse, schemas.ACCESSIONS_TABLE)


# ---------------------------------------------------------------- exports

def _export_roundtrip(spark, sf, name):
    fx = Fixtures(spark, sf)
    path = scratch_path(spark, f"export_{name}")
    export_dataset(fx.staged(name), fx.sample_map, name, path)
    return open_table(spark, path)


def x1(spark, sf):
    return _export_roundtrip(spark, sf, "marker_abundance")


def x2(spark, sf):
    return _export_roundtrip(spark, sf, "marker_presence")


def x3(spark, sf):
    return _export_roundtrip(spark, sf, "marker_rel_ab_w_read_stats")


def x4(spark, sf):
    return _export_roundtrip(spark, sf, "metaphlan_viruses_list")


def b3_manifests(spark, sf):
    """What the manifest of each export says: rows, order of the files' key ranges, and the ends of all keys."""
    fx = Fixtures(spark, sf)
    rows = []
    for name in jobs.EXPORTED:
        made = export_dataset(fx.staged(name), fx.sample_map, name, scratch_path(spark, f"export_{name}"))
        rows.append((name, made.rows, made.ordered(), made.files[0]["first"][0], made.files[-1]["last"][0]))
    return spark.createDataFrame(rows, "dataset string, num_rows long, ordered boolean, first_study string, last_study string")


def b3_failed_export(spark, sf):
    """An export that fails midway: what was exported before is still there."""
    fx = Fixtures(spark, sf)
    path = scratch_path(spark, "export_kept")
    export_dataset(fx.staged("marker_abundance"), fx.sample_map, "marker_abundance", path)
    broken = F.when(F.col("marker_id") == "M7", F.raise_error(F.lit("unreadable row"))).otherwise(F.col("abundance"))
    out = jobs.attempt("marker_abundance", path, lambda: export_dataset(
        fx.staged("marker_abundance").withColumn("abundance", broken), fx.sample_map, "marker_abundance", path))
    return open_table(spark, path).withColumn("failed", F.lit(out.error is not None))


def b2_views(spark, sf):
    """SQL over the registered src_ views of a raw run and over its registered tables."""
    fx = Fixtures(spark, sf)
    top = scratch_path(spark, "views")
    cfg = jobs.Config(raw_root=f"{top}/{schemas.DEFAULT_RUN_TAG}", warehouse=f"{top}/warehouse", datasets=("marker_presence",))
    write_run(fx.by_supplier("marker_presence"), cfg.raw_root, schemas.MARKER_PRESENCE)
    jobs.stage_all(spark, cfg)
    session = spark.newSession()  # views of its own
    jobs.register_src_views(session, cfg)
    jobs.register_tables(session, cfg.warehouse)
    return session.sql("""select 'src' as layer, presence, count(*) as num_rows, count(distinct sample_id) as samples from src_marker_presence
        group by presence union all select 'stg', presence, count(*), count(distinct sample_id) from stg_marker_presence group by presence""")


def _whole_run(spark, sf, bad=()):
    """A raw run of three datasets with its lookups, and the job's settings; files of ``bad`` hold a line that doesn't parse."""
    fx = Fixtures(spark, sf)
    top = scratch_path(spark, "whole_run")
    cfg = jobs.Config(raw_root=f"{top}/{schemas.DEFAULT_RUN_TAG}", warehouse=f"{top}/warehouse", export_root=f"{top}/exports",
                      sample_map_csv=f"{top}/map", accessions_path=f"{top}/accessions", catalog_out=f"{top}/catalog",
                      datasets=("marker_abundance", "marker_presence", "marker_rel_ab_w_read_stats"))
    columns = {"marker_abundance": "abundance", "marker_presence": "presence"}
    for name in cfg.datasets:
        rows = fx.by_supplier(name)
        if name in bad:
            rows = rows.withColumn(columns[name], F.lit("not a number"))
        write_run(rows, cfg.raw_root, schemas.DATASETS[name])
    samples = fx.table("supplier").select(F.md5(F.col("s_suppkey").cast("string")).alias("sample_id"), F.lit("R").alias("run_ids"),
                                          F.lit("S").alias("sample_name"), F.lit("A").alias("study_name"))
    samples.write.option("header", True).csv(cfg.sample_map_csv)
    fx.raw_accessions.write.option("header", True).option("sep", "\t").option("escape", '"').option("emptyValue", "").csv(cfg.accessions_path)
    return cfg


def p1(spark, sf):
    """The whole job with one bad dataset: every other table, layer and export is made, and the failures are told."""
    cfg = _whole_run(spark, sf, bad=("marker_presence",))
    out = jobs.run_all(spark, cfg)
    rows = [("lookup", k, None if isinstance(v, jobs.Outcome) else v["total_rows"]) for k, v in out["lookups"].items()]
    rows += [("staged", k, None if v.error else open_table(spark, v.path).count()) for k, v in out["staged"].items()]
    rows += [("layer", r["layer"], r["num_rows"]) for r in out["layers"]]
    rows += [("export", k, None if v.error else open_table(spark, v.path).count()) for k, v in out["exports"].items()]
    rows += [("catalog", r["table_id"], r["num_rows"]) for r in out["catalog"]["profile"].where("table_type = 'TABLE'").collect()]
    return spark.createDataFrame(rows, "step string, name string, num_rows long")


def p3(spark, sf):
    """Refresh of the lookups where the sample map's file is bad the second time: its old table stays."""
    cfg = _whole_run(spark, sf)
    first = jobs.refresh_lookups(spark, cfg)
    cfg.sample_map_csv = cfg.accessions_path
    second = jobs.refresh_lookups(spark, cfg)
    rows = [(k, isinstance(first[k], jobs.Outcome), isinstance(second[k], jobs.Outcome), read_table(spark, cfg.warehouse, k).count())
            for k in (schemas.SAMPLE_MAP_TABLE, schemas.ACCESSIONS_TABLE)]
    return spark.createDataFrame(rows, "table_id string, failed_first boolean, failed_second boolean, num_rows long")


def p4(spark, sf):
    """The catalog as JSON: the profile read back from what was published."""
    cfg = _whole_run(spark, sf)
    jobs.refresh_staging(spark, cfg)
    jobs.load_sample_map(spark, cfg.sample_map_csv, cfg.warehouse)
    jobs.refresh_metadata(spark, cfg)
    kinds = "table_id string, table_type string, num_fields int, num_rows long, view_query string, error string"
    back = spark.read.schema(kinds).json(f"{folder(spark, cfg.catalog_out)}/tables")
    return back.select("table_id", "table_type", "num_fields", "num_rows", F.col("error").isNotNull().alias("failed"))


def x5(spark, sf):
    stg = Fixtures(spark, sf).staged("marker_abundance")
    path = scratch_path(spark, "export_csv")
    export_csv(stg, path, sample_ids=CHOSEN_SAMPLES)
    return _read_csv(spark, stg.schema, path)


def _read_csv(spark, schema, path):
    """Standard CSV: doubled quotes, line ends inside quotes, an empty field is NULL and ``""`` is empty."""
    mark = "\u0001"
    df = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).option("emptyValue", mark).csv(folder(spark, path))
    return df.select(*[F.when(F.col(f.name) == mark, F.lit("")).otherwise(F.col(f.name)).alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name) for f in schema.fields])


def x5_quoted(spark, sf):
    """CSV export of texts with quotes, separators and line ends."""
    text = Fixtures(spark, sf).quoted_text
    path = scratch_path(spark, "export_csv")
    export_csv(text, path)
    return _read_csv(spark, text.schema, path)


# ---------------------------------------------------------------- checks / catalog

def k1(spark, sf):
    """Layers of raw files of two runs, one of which has no sample ids, as the staging job counted them."""
    ds = schemas.MARKER_REL_AB
    _, src = _two_runs(spark, sf, ds.name)
    cfg = jobs.Config(raw_root="", warehouse=scratch_path(spark, "layers"))
    write_table(staged_rows(src, ds), f"{cfg.warehouse}/{ds.stg_table}", count_rows=True)
    return jobs.verify_layers(spark, cfg, ds.name).drop("expected_stg")


def k1_recount(spark, sf):
    """The same layers, each counted by itself: the raw files once more, and the written table."""
    ds = schemas.MARKER_REL_AB
    ext, src = _two_runs(spark, sf, ds.name)
    path = scratch_path(spark, ds.stg_table)
    write_table(stage(src, ds), path)
    return layer_counts([(ds.ext_table, ext), (ds.src_view, src), (ds.stg_table, open_table(spark, path))])


def k2(spark, sf):
    """Key check of the sample map as loaded from CSV: of the written table."""
    return key_check(j6(spark, sf), "sample_id", "total_rows", "distinct_sample_ids")


def k2b(spark, sf):
    """Key check of the accession table as loaded from TSV: of the written table."""
    return key_check(j7(spark, sf), "Accession", "total_rows", "unique_accessions")


def k3(spark, sf):
    """Preview with provenance (file, sample id) over the raw unknown-list files, first in path order."""
    ds = schemas.UNKNOWN_LIST
    root = f"{scratch_path(spark, 'preview')}/{schemas.DEFAULT_RUN_TAG}"
    write_run(Fixtures(spark, sf).raw_unknown, root, ds)
    first = preview(scan_ext(spark, root, ds).orderBy("file_path", "clade_name"), 3)
    return first.withColumn("file_path", F.substring_index("file_path", "/", -3))


_WAREHOUSES: dict[tuple, list] = {}


def _fixture_catalog(spark, sf) -> list[TableEntry]:
    """Stage the five datasets and the map once per session into a scratch warehouse."""
    app = spark.conf.get("spark.app.id", None)  # of this application: a later one doesn't get its tables
    key = (app, sf)
    if app is None or key not in _WAREHOUSES:
        fx = Fixtures(spark, sf)
        root = scratch_path(spark, "warehouse")
        staged = {f"{root}/{ds.stg_table}": fx.staged(name) for name, ds in schemas.DATASETS.items()}
        with ThreadPoolExecutor(len(staged)) as pool:  # side by side: one table's few tasks don't fill the cores
            list(pool.map(lambda p: write_table(staged[p], p), staged))
        entries = [(p.rsplit("/", 1)[-1], p, ["sample_id"]) for p in staged]
        p = f"{root}/{schemas.SAMPLE_MAP_TABLE}"
        fx.sample_map.write.mode("overwrite").parquet(p)
        entries.append((schemas.SAMPLE_MAP_TABLE, p, []))
        _WAREHOUSES[key] = entries
    return [TableEntry(n, TABLE, open_table(spark, p), path=p, clustering_fields=c)
            for n, p, c in _WAREHOUSES[key]]


def k4(spark, sf):
    """Fields of the staged tables, each with how many rows hold a value."""
    entries = _fixture_catalog(spark, sf)
    parts = []
    for e in entries:
        names = e.open().columns
        one = e.open().agg(*[F.count(F.col(c)).alias(c) for c in names])
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("non_null")) for c in names]))
        parts.append(one.select(F.lit(e.table_id).alias("table_id"), pairs.alias("p")).select("table_id", "p.*"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.union(p)
    return schema_catalog(spark, entries).join(counts, ["table_id", "field_name"])


def k5_errors(spark, sf):
    """Profile of a warehouse in which one table is missing and one unreadable: both listed with an error."""
    broken = scratch_path(spark, "broken")
    Fixtures(spark, sf).sample_map.write.option("header", True).csv(broken)
    good = _fixture_catalog(spark, sf)
    entries = good + [TableEntry("stg_missing", TABLE, lambda: spark.read.parquet(broken + "-nowhere")),
                      TableEntry("stg_unreadable", TABLE, lambda: spark.read.schema("a int").parquet(broken), path=broken)]
    return table_profile(spark, entries).select("table_id", "num_rows", F.col("error").isNotNull().alias("failed"))


def k5(spark, sf):
    """Profile of the staged tables; byte sizes depend on the writer, so they are left out."""
    prof = table_profile(spark, _fixture_catalog(spark, sf))
    return prof.select("table_id", "table_type", "num_fields", "num_rows",
                       F.array_join("clustering_fields", ",").alias("clustering_fields"),
                       "view_query", "external_config", "error")


def k6(spark, sf):
    """Catalog summary; the per-type / per-prefix maps are shown as their entries."""
    s = catalog_summary(table_profile(spark, _fixture_catalog(spark, sf)))
    return s.select("total_tables", "total_rows",
                    F.col("by_type").getItem("TABLE").alias("tables"),
                    F.col("by_prefix").getItem("stg_").alias("stg_tables"),
                    F.col("by_prefix").getItem("src_").alias("src_tables"),
                    F.size("by_type").alias("n_types"), F.size("by_prefix").alias("n_prefixes"))


def k7(spark, sf):
    return table_listing(table_profile(spark, _fixture_catalog(spark, sf))).drop("size_gb")


# ---------------------------------------------------------------- single operators

def c1_regexp_extract(spark, sf):
    """Sample id from a file path; paths outside the run tag give NULL."""
    li = Fixtures(spark, sf).table("lineitem")
    tag = F.when(F.col("l_linenumber") == 3, F.lit("other")).otherwise(F.lit(schemas.DEFAULT_RUN_TAG))
    path = F.concat(F.lit("gs://bucket/results/"), tag, F.lit("/"), F.md5(F.col("l_orderkey").cast("string")),
                    F.lit("/metaphlan_markers/marker_abundance.tsv.gz"))
    paths = li.select(path.alias("file_path"))
    return paths.select("file_path", sample_id_from_path("file_path").alias("sample_id"))


def c4_lenient_casts(spark, sf):
    raw = Fixtures(spark, sf).raw_rel_ab
    return raw.select("sample_id", "clade_name",
                      lenient_double("relative_abundance").alias("relative_abundance"),
                      lenient_double(null_sentinel("coverage")).alias("coverage"),
                      lenient_long("estimated_reads").alias("estimated_reads"))


def d4_in_param(spark, sf):
    """``IN UNNEST(@ids)``: a list bound as values, which reaches the Parquet scan as ``In``."""
    return Q.restrict_samples(Fixtures(spark, sf).staged("marker_abundance"), CHOSEN_SAMPLES)


def c4_odd_values(spark, sf):
    """Casts of strings that engines read differently."""
    return Fixtures(spark, sf).odd_numbers.select("l_orderkey", "l_linenumber", "text", lenient_double("text").alias("as_double"),
                                                  lenient_long("text").alias("as_long"))


def d5_like(spark, sf):
    rel = Fixtures(spark, sf).rel_ab
    return rel.where(F.col("clade_name").like(Q.KINGDOM_ANY)).select("sample_id", "clade_name")


def d7_not_like(spark, sf):
    return Q.kingdom_rows(Fixtures(spark, sf).rel_ab).select("sample_id", "clade_name", "relative_abundance")


def f9_count_if(spark, sf):
    pres = Fixtures(spark, sf).staged("marker_presence")
    return pres.groupBy("marker_id").agg(count_if(F.col("presence") == 1).alias("present_rows"))


def f10_string_agg(spark, sf):
    """Per sample, its kingdom-level clades as one ordered, comma-separated string."""
    kingdoms = Q.kingdom_rows(Fixtures(spark, sf).rel_ab)
    return kingdoms.groupBy("sample_id").agg(ordered_string_agg("clade_name").alias("kingdoms"))


def g4_topk(spark, sf):
    rel = Fixtures(spark, sf).rel_ab
    return (rel.select("sample_id", "clade_name", "relative_abundance")
               .orderBy(*Q.nan_low("relative_abundance", ascending=False), "sample_id", "clade_name")
               .limit(100))


def e1_inner_join(spark, sf):
    fx = Fixtures(spark, sf)
    return join_sample_map(fx.staged("marker_abundance"), fx.sample_map, ["run_ids", "sample_name", "study_name"])


def e2_left_join(spark, sf):
    fx = Fixtures(spark, sf)
    studies = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return Q.study_samples_marker_counts(fx.sample_map, fx.staged("marker_abundance"), studies)


def f13_distinct(spark, sf):
    return Fixtures(spark, sf).rel_ab.select("sample_id").distinct()


def f14_pivot(spark, sf):
    """Kingdom rows of every sample, summed per cell, pivoted wide."""
    long = Q.kingdom_rows(Fixtures(spark, sf).rel_ab).select("sample_id", "clade_name", "relative_abundance")
    return pivot_wide(long, "sample_id", "clade_name", "relative_abundance", values=KINGDOMS, cell="sum")


def f14_unique(spark, sf):
    """The pivot that refuses duplicate cells, over cells made unique."""
    long = Q.kingdom_rows(Fixtures(spark, sf).rel_ab).groupBy("sample_id", "clade_name").agg(F.max("relative_abundance").alias("top"))
    return pivot_wide(long, "sample_id", "clade_name", "top", values=KINGDOMS, cell="unique")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top markers by mean abundance on sf0.001."""
    return q2(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "Q1_sample_lookup": q1,
        "Q2_top_markers_by_mean": q2,
        "Q2b_top_markers_by_samples": q2b,
        "Q3_sample_profiles": q3,
        "Q4_samples_with_taxon": q4,
        "Q5_viral_summary": q5,
        "Q6_presence_comparison": q6,
        "Q7_profiles_with_study": q7,
        "Q8_study_marker_counts": q8,
        "Q9_markers_per_sample": q9,
        "Q10_approx_distinct_samples": q10,
        "Q11_sampled_scan": q11,
        "Q11b_sampled_whole_samples": q11b,
        "G5_limit": g5,
        "Q6_long": q6_long,
        "Q12_kingdom_long": q12,
        "Q13_kingdom_wide": q13,
        "J1_stage_marker_abundance": j1,
        "J2_stage_marker_presence": j2,
        "J3_stage_marker_rel_ab": j3,
        "J4_stage_unknown_list": j4,
        "J5_stage_viruses_list": j5,
        "J4r_raw_stage_unknown_list": j4_raw,
        "J5r_raw_stage_viruses_list": j5_raw,
        "J5l_raw_lines_stage_viruses_list": j5_raw_lines,
        "J1r_raw_run_abundance": j1_run,
        "J2r_raw_run_presence": j2_run,
        "J3r_raw_run_rel_ab": j3_run,
        "D1_key_filter": d1,
        "A4_file_column": a4,
        "P2_refresh_staging": p2,
        "J6_load_sample_map": j6,
        "J7_load_accessions": j7,
        "J7_multiline": j7_multiline,
        "X1_export_marker_abundance": x1,
        "X2_export_marker_presence": x2,
        "X3_export_marker_rel_ab": x3,
        "X4_export_viruses_list": x4,
        "X5_export_csv": x5,
        "X5_quoted_csv": x5_quoted,
        "Q2_bitmaps": q2_bitmaps,
        "Q2b_bitmaps": q2b_bitmaps,
        "Q4_names": q4_names,
        "Q10_sketches": q10_sketches,
        "Q12_names": q12_names,
        "G7_block_sample": g7_blocks,
        "B2_views": b2_views,
        "B3_failed_export": b3_failed_export,
        "B3_manifests": b3_manifests,
        "P1_run_all": p1,
        "P3_refresh_lookups": p3,
        "P4_refresh_metadata": p4,
        "K1_layer_counts": k1,
        "K1_recount": k1_recount,
        "K2_key_check_map": k2,
        "K2b_key_check_accessions": k2b,
        "K3_preview_with_provenance": k3,
        "K4_schema_catalog": k4,
        "K5_table_profile": k5,
        "K5_with_errors": k5_errors,
        "K6_catalog_summary": k6,
        "K7_table_listing": k7,
        "C1_sample_id_from_path": c1_regexp_extract,
        "C4_lenient_casts": c4_lenient_casts,
        "C4_odd_values": c4_odd_values,
        "D4_in_param": d4_in_param,
        "D5_like": d5_like,
        "D7_not_like": d7_not_like,
        "E1_inner_join": e1_inner_join,
        "E2_left_join_counts": e2_left_join,
        "F9_count_if": f9_count_if,
        "F10_string_agg": f10_string_agg,
        "F13_distinct_samples": f13_distinct,
        "F14_pivot_all_samples": f14_pivot,
        "F14_unique": f14_unique,
        "G4_topk": g4_topk,
        **(llm_queries.QUERIES | {"pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


# ---------------------------------------------------------------- oracle SQL

def _stage_sql(view: str) -> str:
    return with_views(f"select * from {view} where sample_id is not null", view)


def _export_sql(view: str, cols: list[str]) -> str:
    sel = ", ".join(f"a.{c}" for c in cols)
    return with_views(f"""
select {sel}, b.study_name, b.sample_name
from {view} a join src_sample_id_map b on a.sample_id = b.sample_id""", view, "src_sample_id_map")


def _cols(name: str) -> list[str]:
    return ["sample_id", *[f.name for f in schemas.DATASETS[name].raw_schema.fields]]


def _catalog_sql() -> str:
    """Fields of the fixture warehouse with their types, and the values counted in each view."""
    tables = {ds.stg_table: [(f.name, f.dataType.simpleString()) for f in ds.staged_schema().fields] for ds in schemas.DATASETS.values()}
    tables[schemas.SAMPLE_MAP_TABLE] = [(c, "string") for c in MAP_COLS]
    names = {"string": "STRING", "double": "FLOAT", "bigint": "INTEGER"}
    rows = [f"select '{t}' as table_id, {i} as position, '{c}' as field_name, '{names[kind]}' as field_type, 'NULLABLE' as mode, "
            f"(select count({c}) from {t}) as non_null" for t, fields in tables.items() for i, (c, kind) in enumerate(fields)]
    return with_views("\nunion all\n".join(rows), *tables)


def _kingdom_cells(agg: str) -> str:
    """A column for each kingdom, by a conditional aggregate."""
    return ", ".join(f"""{agg}(case when clade_name = '{k}' then relative_abundance end) as "{k}\"""" for k in KINGDOMS)


def _odd_sql() -> str:
    """The expected casts, spelled out for each odd string."""
    pick = " ".join(f"when {i} then '{v}'" for i, v in enumerate(ODD_NUMBERS))
    known = lambda at: " ".join(f"when '{v}' then {pair[at]}" for v, pair in ODD_NUMBERS.items() if pair[at] is not None)
    return f"""
with t as (select l_orderkey, l_linenumber, case l_partkey % {len(ODD_NUMBERS)} {pick} end as text from lineitem)
select l_orderkey, l_linenumber, text, cast(case text {known(0)} end as double) as as_double,
       cast(case text {known(1)} end as bigint) as as_long from t"""


def _profile_sql() -> str:
    """Expected profile rows of the fixture warehouse (five staged tables and the map)."""
    views = [ds.stg_table for ds in schemas.DATASETS.values()] + [schemas.SAMPLE_MAP_TABLE]
    parts = []
    for v in views:
        n_fields = (len(MAP_COLS) if v == schemas.SAMPLE_MAP_TABLE
                    else len(schemas.DATASETS[v[len("stg_"):]].staged_schema().fields))
        clustering = "'sample_id'" if v.startswith("stg_") else "''"
        parts.append(f"select '{v}' as table_id, 'TABLE' as table_type, {n_fields} as num_fields, "
                     f"(select count(*) from {v}) as num_rows, {clustering} as clustering_fields, "
                     f"cast(null as varchar) as view_query, cast(null as varchar) as external_config, "
                     f"cast(null as varchar) as error")
    return with_views("\nunion all\n".join(parts), *views)


def _layers_sql(rel: str) -> str:
    return with_views(f"""
, counts as (
  select 0 as position, 'ext_marker_rel_ab_w_read_stats' as layer, count(*) as num_rows from run_raw_rel_ab
  union all select 1, 'src_marker_rel_ab_w_read_stats', count(*) from run_raw_rel_ab
  union all select 2, '{rel}', count(*) from run_{rel}
    where sample_id in (select md5(cast(s_suppkey as varchar(20))) from supplier where s_suppkey % 2 = 0))
select position, layer, num_rows, lag(num_rows) over (order by position) - num_rows as dropped
from counts""", f"run_{rel}")


def oracle_sql() -> dict[str, str]:
    ids = _sql_list(CHOSEN_SAMPLES)
    tag = schemas.DEFAULT_RUN_TAG
    rel = "stg_marker_rel_ab_w_read_stats"
    found = {
        "Q1_sample_lookup": with_views(
            f"select * from stg_marker_abundance where sample_id = '{POINT_SAMPLE}'", "stg_marker_abundance"),
        "Q2_top_markers_by_mean": with_views("""
select marker_id, count(distinct sample_id) as sample_count, round(avg(abundance), 6) as avg_abundance,
       max(abundance) as max_abundance, min(abundance) as min_abundance
from stg_marker_abundance group by marker_id
order by avg(abundance) desc, marker_id limit 20""", "stg_marker_abundance"),
        "Q2b_top_markers_by_samples": with_views("""
select marker_id, count(distinct sample_id) as sample_count, round(avg(abundance), 6) as avg_abundance,
       max(abundance) as max_abundance
from stg_marker_abundance group by marker_id
order by sample_count desc, marker_id limit 10""", "stg_marker_abundance"),
        "Q3_sample_profiles": with_views(f"""
select sample_id, clade_name, relative_abundance, coverage, estimated_reads
from {rel} where sample_id in ({ids}) and clade_name like 'k__%'
order by sample_id, relative_abundance desc nulls last""", rel),
        "Q4_samples_with_taxon": with_views(f"""
select sample_id, clade_name, relative_abundance from {rel}
where clade_name like '{TAXON_LIKE}' and relative_abundance > 10.0
order by relative_abundance desc, sample_id, clade_name limit 100""", rel),
        "Q5_viral_summary": with_views("""
select sample_id, count(*) as viral_count, cast(sum(mapping_reads_count) as bigint) as total_viral_reads,
       round(avg(breadth_of_coverage), 6) as avg_coverage
from stg_metaphlan_viruses_list group by sample_id having count(*) > 5
order by total_viral_reads desc, sample_id limit 50""", "stg_metaphlan_viruses_list"),
        "Q6_presence_comparison": with_views(f"""
select marker_id, count(*) as present_in_samples, string_agg(sample_id, ',' order by sample_id) as samples_with_marker
from stg_marker_presence p
where presence = 1 and exists (select 1 from src_sample_id_map s where s.sample_id = p.sample_id and s.study_name = '{STUDY}')
group by marker_id having count(*) > 1
order by 2 desc, 1""", "stg_marker_presence", "src_sample_id_map"),
        "Q6_long": with_views(f"""
select marker_id, sample_id from stg_marker_presence
where presence = 1 and sample_id in (select sample_id from src_sample_id_map where study_name = '{STUDY}')""",
            "stg_marker_presence", "src_sample_id_map"),
        "Q7_profiles_with_study": with_views(f"""
, members as (select * from src_sample_id_map where study_name = '{STUDY}')
, profiles as (select * from {rel} where starts_with(clade_name, 'k__'))
select study_name, run_ids, sample_name, sample_id, clade_name, relative_abundance
from profiles join members using (sample_id)
order by relative_abundance desc nulls last, sample_id, clade_name limit 100""",
            rel, "src_sample_id_map"),
        "Q8_study_marker_counts": with_views(f"""
, per_sample as (select sample_id, count(distinct marker_id) as n from stg_marker_abundance group by sample_id)
, members as (select * from src_sample_id_map where study_name in ({_sql_list(STUDIES)}))
select m.sample_id, run_ids, sample_name, study_name, coalesce(n, 0) as marker_count
from members m left join per_sample p on p.sample_id = m.sample_id
order by marker_count desc, m.sample_id""", "src_sample_id_map", "stg_marker_abundance"),
        "Q9_markers_per_sample": with_views("""
select sample_id, count(*) as marker_count from stg_marker_abundance
group by sample_id order by sample_id limit 10""", "stg_marker_abundance"),
        "Q12_kingdom_long": with_views(f"""
, samples as (select distinct sample_id from {rel} order by sample_id limit 10)
select sample_id, clade_name, relative_abundance from {rel}
where sample_id in (select sample_id from samples)
  and clade_name like 'k__%' and clade_name not like 'k__%|%'
order by sample_id, relative_abundance desc nulls last""", rel),
        "Q13_kingdom_wide": with_views(f"""
select sample_id, {_kingdom_cells("sum")} from {rel}
where sample_id in (select distinct sample_id from {rel} order by sample_id limit 10)
  and clade_name like 'k__%' and clade_name not like 'k__%|%'
group by sample_id""", rel),
        "F14_pivot_all_samples": with_views(f"""
select sample_id, {_kingdom_cells("sum")} from {rel}
where clade_name like 'k__%' and clade_name not like 'k__%|%' group by sample_id""", rel),
        "F14_unique": with_views(f"""
select sample_id, {_kingdom_cells("max")} from {rel}
where clade_name like 'k__%' and clade_name not like 'k__%|%' group by sample_id""", rel),
        "Q10_approx_distinct_samples": with_views(
            "select count(distinct sample_id) as exact_samples, true as within_bound from stg_marker_abundance", "stg_marker_abundance"),
        "Q11_sampled_scan": "select count(*) as total_rows, true as is_subset, true as within_5_sigma from lineitem",
        "Q11b_sampled_whole_samples": with_views(f"""
select sample_id, marker_id, abundance from stg_marker_abundance
where cast('0x' || substr(md5(sample_id), 1, {HASH_DIGITS}) as bigint) < {key_bound(1.0)}""", "stg_marker_abundance"),
        "G5_limit": "select least(1000, count(*)) as limited_rows from lineitem",
        "K3_preview_with_provenance": with_views(f"""
select sample_id || '/{schemas.UNKNOWN_LIST.path_tail}' as file_path, sample_id, clade_name, ncbi_tax_id, relative_abundance
from raw_unknown order by sample_id, clade_name limit 3""", "raw_unknown"),
        "A4_file_column": f"""
select case when l_suppkey % 2 = 0 then '{tag}' else 'other_run' end || '/' || md5(cast(l_suppkey as varchar(20)))
       || '/{schemas.MARKER_PRESENCE.path_tail}' as file, count(*) as num_rows
from lineitem group by 1""",
        "D1_key_filter": with_views("""
select * from run_stg_marker_presence
where sample_id in (select md5(cast(s_suppkey as varchar(20))) from supplier where s_suppkey % 2 = 0)""", "run_stg_marker_presence"),
        "J1r_raw_run_abundance": with_views("select * from run_stg_marker_abundance", "run_stg_marker_abundance"),
        "J2r_raw_run_presence": with_views("select * from run_stg_marker_presence", "run_stg_marker_presence"),
        "J3r_raw_run_rel_ab": with_views(f"select * from run_{rel}", f"run_{rel}"),
        "P2_refresh_staging": """
select 'stg_marker_abundance' as table_id, false as refreshed, count(*) as num_rows from lineitem
union all select 'stg_marker_presence', true, count(*) from lineitem""",
        "X5_quoted_csv": """
select cast(o_orderkey as varchar(20)) as id, o_orderpriority as last,
       case o_orderkey % 6 when 0 then 'a "b", c ' || cast(o_orderkey as varchar(20)) when 1 then '' when 2 then null
            when 3 then '""' when 4 then 'two' || chr(10) || 'lines, \\ back' else 'plain' end as text
from orders""",
        "B2_views": with_views("""
select 'src' as layer, presence, count(*) as num_rows, count(distinct sample_id) as samples from run_stg_marker_presence group by presence
union all select 'stg', presence, count(*), count(distinct sample_id) from run_stg_marker_presence group by presence""",
                               "run_stg_marker_presence"),
        "B3_failed_export": f"select *, true as failed from ({_export_sql('stg_marker_abundance', _cols('marker_abundance'))})",
        "B3_manifests": with_views("\nunion all ".join(f"""
select '{n}' as dataset, count(*) as num_rows, true as ordered, min(study_name) as first_study, max(study_name) as last_study
from stg_{n} join src_sample_id_map using (sample_id)""" for n in jobs.EXPORTED), *[f"stg_{n}" for n in jobs.EXPORTED], "src_sample_id_map"),
        "P1_run_all": """
with n as (select (select count(*) from lineitem) as abundance, (select count(*) from lineitem join part on l_partkey = p_partkey) as rel,
  (select count(*) from supplier) as samples, (select count(*) from orders) as accessions)
select unnest(['lookup', 'lookup', 'staged', 'staged', 'staged', 'layer', 'layer', 'layer', 'layer', 'layer', 'layer', 'export', 'export', 'export',
    'catalog', 'catalog', 'catalog', 'catalog']) as step,
  unnest(['src_sample_id_map', 'src_sra_accessions', 'stg_marker_abundance', 'stg_marker_presence', 'stg_marker_rel_ab_w_read_stats',
    'ext_marker_abundance', 'src_marker_abundance', 'stg_marker_abundance', 'ext_marker_rel_ab_w_read_stats', 'src_marker_rel_ab_w_read_stats',
    'stg_marker_rel_ab_w_read_stats', 'marker_abundance', 'marker_presence', 'marker_rel_ab_w_read_stats', 'src_sample_id_map',
    'src_sra_accessions', 'stg_marker_abundance', 'stg_marker_rel_ab_w_read_stats']) as name,
  unnest([samples, accessions, abundance, null, rel, abundance, abundance, abundance, rel, rel, rel, abundance, null, rel,
    samples, accessions, abundance, rel]) as num_rows from n""",
        "P3_refresh_lookups": """
select 'src_sample_id_map' as table_id, false as failed_first, true as failed_second, count(*) as num_rows from supplier
union all select 'src_sra_accessions', false, false, count(*) from orders""",
        "P4_refresh_metadata": """
with n as (select (select count(*) from lineitem) as rows, (select count(*) from lineitem join part on l_partkey = p_partkey) as rel,
  (select count(*) from supplier) as samples)
select unnest(['ext_marker_abundance', 'ext_marker_presence', 'ext_marker_rel_ab_w_read_stats', 'src_marker_abundance', 'src_marker_presence',
    'src_marker_rel_ab_w_read_stats', 'stg_marker_abundance', 'stg_marker_presence', 'stg_marker_rel_ab_w_read_stats', 'src_sample_id_map',
    'src_sra_accessions']) as table_id,
  unnest(['EXTERNAL', 'EXTERNAL', 'EXTERNAL', 'VIEW', 'VIEW', 'VIEW', 'TABLE', 'TABLE', 'TABLE', 'TABLE', null]) as table_type,
  unnest([2, 2, 5, 3, 3, 6, 3, 3, 6, 4, null]) as num_fields,
  unnest([null, null, null, null, null, null, rows, rows, rel, samples, null]) as num_rows,
  unnest([false, false, false, false, false, false, false, false, false, false, true]) as failed from n""",
        "C4_odd_values": _odd_sql(),
        "K5_with_errors": f"""
with p as ({_profile_sql()})
select table_id, num_rows, false as failed from p
union all select 'stg_missing', null, true union all select 'stg_unreadable', null, true""",
        "J1_stage_marker_abundance": _stage_sql("stg_marker_abundance"),
        "J2_stage_marker_presence": _stage_sql("stg_marker_presence"),
        "J3_stage_marker_rel_ab": _stage_sql(rel),
        "J4_stage_unknown_list": _stage_sql("stg_metaphlan_unknown_list"),
        "J5_stage_viruses_list": _stage_sql("stg_metaphlan_viruses_list"),
        "J4r_raw_stage_unknown_list": _stage_sql("stg_metaphlan_unknown_list"),
        "J5r_raw_stage_viruses_list": _stage_sql("stg_metaphlan_viruses_list"),
        "J5l_raw_lines_stage_viruses_list": _stage_sql("stg_metaphlan_viruses_list"),
        "J6_load_sample_map": with_views("select * from src_sample_id_map", "src_sample_id_map"),
        "J7_load_accessions": with_views("select * from src_sra_accessions", "src_sra_accessions"),
        "J7_multiline": with_views("""
select Accession, Submission, Status, Spots, case Spots % 7 when 0 then 'two' || chr(10) || 'lines "' || Spots || '"'
  when 1 then 'crlf' || chr(13) || chr(10) || 'and' || chr(9) || 'tab' || chr(10) || chr(10) when 2 then '"' || chr(10) || '"' else Center end as Center
from src_sra_accessions""", "src_sra_accessions"),
        "X1_export_marker_abundance": _export_sql("stg_marker_abundance", _cols("marker_abundance")),
        "X2_export_marker_presence": _export_sql("stg_marker_presence", _cols("marker_presence")),
        "X3_export_marker_rel_ab": _export_sql(rel, _cols("marker_rel_ab_w_read_stats")),
        "X4_export_viruses_list": _export_sql("stg_metaphlan_viruses_list", _cols("metaphlan_viruses_list")),
        "X5_export_csv": with_views(
            f"select * from stg_marker_abundance where sample_id in ({ids})", "stg_marker_abundance"),
        "K1_layer_counts": _layers_sql(rel),
        "K1_recount": _layers_sql(rel),
        "K2_key_check_map": with_views("""
select count(*) as total_rows, count(distinct sample_id) as distinct_sample_ids
from src_sample_id_map""", "src_sample_id_map"),
        "K2b_key_check_accessions": with_views("""
select count(*) as total_rows, count(distinct Accession) as unique_accessions
from raw_accessions""", "raw_accessions"),
        "K4_schema_catalog": _catalog_sql(),
        "K5_table_profile": _profile_sql(),
        "K6_catalog_summary": f"""
with p as ({_profile_sql()})
select cast(count(*) as bigint) as total_tables, cast(sum(num_rows) as bigint) as total_rows,
       cast(count(*) filter (where table_type = 'TABLE') as bigint) as tables,
       cast(count(*) filter (where table_id like 'stg\\_%' escape '\\') as bigint) as stg_tables,
       cast(count(*) filter (where table_id like 'src\\_%' escape '\\') as bigint) as src_tables,
       cast(count(distinct table_type) as integer) as n_types,
       cast(count(distinct split_part(table_id, '_', 1)) as integer) as n_prefixes
from p""",
        "K7_table_listing": f"""
with p as ({_profile_sql()})
select table_id, table_type, num_rows, error from p""",
        "C1_sample_id_from_path": f"""
with p as (
  select concat('gs://bucket/results/', case when l_linenumber = 3 then 'other' else '{tag}' end, '/',
                md5(cast(l_orderkey as varchar(20))), '/metaphlan_markers/marker_abundance.tsv.gz') as file_path
  from lineitem)
select file_path, nullif(regexp_extract(file_path, '/{tag}/([^/]+)/', 1), '') as sample_id from p""",
        "C4_lenient_casts": with_views("""
select sample_id, clade_name, try_cast(relative_abundance as double) as relative_abundance,
       try_cast(nullif(coverage, '-') as double) as coverage,
       try_cast(estimated_reads as bigint) as estimated_reads
from raw_rel_ab""", "raw_rel_ab"),
        "D4_in_param": with_views(
            f"select sample_id, marker_id, abundance from stg_marker_abundance where sample_id in ({ids})",
            "stg_marker_abundance"),
        "D5_like": with_views(f"select sample_id, clade_name from {rel} where clade_name like 'k__%'", rel),
        "D7_not_like": with_views(f"""
select sample_id, clade_name, relative_abundance from {rel}
where clade_name like 'k__%' and clade_name not like 'k__%|%'""", rel),
        "F9_count_if": with_views("""
select marker_id, cast(count_if(presence = 1) as bigint) as present_rows
from stg_marker_presence group by marker_id""", "stg_marker_presence"),
        "F10_string_agg": with_views(f"""
select sample_id, string_agg(clade_name, ',' order by clade_name) as kingdoms from {rel}
where clade_name like 'k__%' and clade_name not like 'k__%|%' group by sample_id""", rel),
        "G4_topk": with_views(f"""
select sample_id, clade_name, relative_abundance from {rel}
order by relative_abundance desc nulls last, sample_id, clade_name limit 100""", rel),
        "E1_inner_join": with_views("""
select a.sample_id, a.marker_id, a.abundance, b.run_ids, b.sample_name, b.study_name
from stg_marker_abundance a join src_sample_id_map b on a.sample_id = b.sample_id""",
            "stg_marker_abundance", "src_sample_id_map"),
        "E2_left_join_counts": with_views("""
select map.sample_id, map.run_ids, map.sample_name, map.study_name,
       cast(count(distinct data.marker_id) as bigint) as marker_count
from src_sample_id_map as map left join stg_marker_abundance as data on map.sample_id = data.sample_id
group by map.sample_id, map.run_ids, map.sample_name, map.study_name""",
            "src_sample_id_map", "stg_marker_abundance"),
        "F13_distinct_samples": with_views(f"select distinct sample_id from {rel}", rel),
        "Q10_sketches": """
select 'sample_id' as column_name, count(distinct l_orderkey) as exact, true as within_bound from lineitem
union all select 'marker_id', count(distinct l_partkey), true from lineitem""",
        "G7_block_sample": "select count(*) as total_rows, true as is_subset, true as within_5_sigma from lineitem",
        **(llm_queries.ORACLES if llm_queries else {}),
    }
    # The same results by other means.
    same = {"Q2_bitmaps": "Q2_top_markers_by_mean", "Q2b_bitmaps": "Q2b_top_markers_by_samples", "Q4_names": "Q4_samples_with_taxon",
            "Q12_names": "Q12_kingdom_long"}
    return found | {key: found[of] for key, of in same.items()}
