"""Command line: ``python -m taxaspark <command> ...``, or on a cluster
``spark-submit --py-files taxaspark.zip taxaspark/__main__.py <command> ...``.

Commands map one to one onto ``plans.jobs``:

  run-all       lookups, staging, layer check, catalog, exports   (P1)
  stage         staged tables + catalog                            (P2)
  load-lookups  sample map and accession tables                    (P3)
  catalog       schema / profile / summary JSON                    (P4)
  export        sorted zstd Parquet exports                        (X1-X4)
  show-tables   table listing with rows and size                   (K7)
  preview       three rows of every raw (with file path) and staged table   (K3)
"""

from __future__ import annotations

import argparse
import sys

from taxaspark.plans import jobs as P
from taxaspark.schemas import DATASETS, DEFAULT_RUN_TAG


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="taxaspark")
    ap.add_argument("command", choices=["run-all", "stage", "load-lookups", "catalog", "export",
                                        "show-tables", "preview"])
    ap.add_argument("--raw-root", required=True, help="folder with one sub-folder per sample")
    ap.add_argument("--warehouse", required=True, help="where staged and lookup tables live")
    ap.add_argument("--export-root")
    ap.add_argument("--sample-map-csv")
    ap.add_argument("--accessions")
    ap.add_argument("--catalog-out")
    ap.add_argument("--run-tag", default=DEFAULT_RUN_TAG)
    ap.add_argument("--layout", default="range", choices=["range", "local"])
    ap.add_argument("--range-partitions", type=int)
    ap.add_argument("--listing", default="recursive", choices=["glob", "recursive"])
    ap.add_argument("--read-mode", default="auto", choices=["auto", "lines", "wholetext"])
    ap.add_argument("--accessions-one-line-rows", action="store_true", help="the dump has no quoted newlines (saves a pass)")
    ap.add_argument("--accessions-schema", help="column types as DDL; nothing is inferred")
    ap.add_argument("--companions", action="store_true", help="publish names and sketches with each staged table")
    ap.add_argument("--max-partition-bytes", type=int, help="compressed bytes per staging task")
    ap.add_argument("--datasets", nargs="*", default=list(DATASETS), choices=list(DATASETS))
    return ap


def config(args) -> P.Config:
    return P.Config(raw_root=args.raw_root, warehouse=args.warehouse, export_root=args.export_root,
                    sample_map_csv=args.sample_map_csv, accessions_path=args.accessions,
                    catalog_out=args.catalog_out, run_tag=args.run_tag, layout=args.layout,
                    range_partitions=args.range_partitions, listing=args.listing,
                    read_mode=args.read_mode, max_partition_bytes=args.max_partition_bytes,
                    accessions_multiline=not args.accessions_one_line_rows, accessions_schema=args.accessions_schema, companions=args.companions,
                    datasets=tuple(args.datasets))


def show_lookups(spark, cfg: P.Config, lookups: dict) -> None:
    """Key check of each loaded lookup, and some of its rows."""
    for name, check in lookups.items():
        if isinstance(check, P.Outcome):
            print(name, "failed; its old table stays")
            continue
        print(name, check.asDict())
        P.lookup_sample(spark, cfg.warehouse, name).show(truncate=False)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    cfg = config(args)
    if spark is None:
        from taxaspark.session import get_session
        spark = get_session(app=f"taxaspark-{args.command}")
    out = {}
    if args.command == "run-all":
        out = P.run_all(spark, cfg)
        show_lookups(spark, cfg, out["lookups"])
        for row in out["layers"]:
            print(row.asDict())
        if "summary" in out["catalog"]:
            out["catalog"]["summary"].show(truncate=False)
    elif args.command == "stage":
        out = {"staged": P.refresh_staging(spark, cfg)["staged"]}
        for name, made in out["staged"].items():
            print(name, "failed; its old table stays" if made.error else made.path)
    elif args.command == "load-lookups":
        out = P.refresh_lookups(spark, cfg)
        show_lookups(spark, cfg, out)
    elif args.command == "catalog":
        P.refresh_metadata(spark, cfg)["summary"].show(truncate=False)
    elif args.command == "export":
        out = P.export_all(spark, cfg)
        for name, made in out.items():
            print(name, "failed" if made.error else made.path)
    elif args.command == "show-tables":
        from taxaspark.operators.catalog import table_listing, table_profile
        listing = table_listing(table_profile(spark, P.catalog_entries(spark, cfg)))
        listing.show(listing.count(), truncate=False)
    elif args.command == "preview":
        from taxaspark.operators.checks import preview
        raw_views = P.register_src_views(spark, cfg)
        names = [n for n in raw_views if n.startswith("ext_")] + P.register_tables(spark, cfg.warehouse)
        for name in names:
            print(name)
            preview(spark.table(name), 3).show(truncate=False)
    errors = P.failed(out)
    for message in errors:
        print("FAILED", message, file=sys.stderr)
    return 1 if errors else 0


if __name__ == "__main__":
    sys.exit(main())
