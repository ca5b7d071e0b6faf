"""Dataset specifications: raw file layout, declared schemas and staged casts.

Each per-sample profile dataset is one gzipped TSV per sample, found under
``<root>/<sample_id>/<path_tail>``.  The first ``skip_rows`` lines of every
file are headers and are skipped by position.  Raw numeric columns are strict
(a bad value fails the read); string columns pass through and are cast
leniently at staging (bad values become NULL).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# How a staged column is derived from its raw counterpart.
KEEP = "keep"            # passed through unchanged
DOUBLE = "double"        # lenient cast to double (NULL on failure)
LONG = "long"            # lenient cast to bigint (NULL on failure)
DOUBLE_DASH = "double-"  # '-' means NULL, then lenient cast to double


@dataclass(frozen=True)
class Dataset:
    name: str
    path_tail: str
    skip_rows: int
    raw_schema: T.StructType
    casts: dict = field(default_factory=dict)

    @property
    def ext_table(self) -> str:
        return f"ext_{self.name}"

    @property
    def src_view(self) -> str:
        return f"src_{self.name}"

    @property
    def stg_table(self) -> str:
        return f"stg_{self.name}"

    def staged_schema(self) -> T.StructType:
        fields = [T.StructField("sample_id", T.StringType(), True)]
        for f in self.raw_schema.fields:
            kind = self.casts.get(f.name, KEEP)
            if kind == KEEP:
                dtype = f.dataType
            elif kind == LONG:
                dtype = T.LongType()
            else:
                dtype = T.DoubleType()
            fields.append(T.StructField(f.name, dtype, True))
        return T.StructType(fields)


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


S, D, L = T.StringType(), T.DoubleType(), T.LongType()

# The path segment that precedes the sample id in raw file
# paths, and the five dataset layouts (path tail, header lines skipped,
# declared raw schema, staged casts) that staged tables must reproduce.
DEFAULT_RUN_TAG = "cMDv4"

MARKER_ABUNDANCE = Dataset(
    "marker_abundance",
    "metaphlan_markers/marker_abundance.tsv.gz",
    4,
    _schema(("marker_id", S), ("abundance", D)),
    {"abundance": DOUBLE},
)
MARKER_PRESENCE = Dataset(
    "marker_presence",
    "metaphlan_markers/marker_presence.tsv.gz",
    4,
    _schema(("marker_id", S), ("presence", L)),
    {"presence": LONG},
)
MARKER_REL_AB = Dataset(
    "marker_rel_ab_w_read_stats",
    "metaphlan_markers/marker_rel_ab_w_read_stats.tsv.gz",
    6,
    _schema(("clade_name", S), ("clade_taxid", S), ("relative_abundance", S),
            ("coverage", S), ("estimated_reads", S)),
    {"relative_abundance": DOUBLE, "coverage": DOUBLE_DASH, "estimated_reads": LONG},
)
UNKNOWN_LIST = Dataset(
    "metaphlan_unknown_list",
    "metaphlan_lists/metaphlan_unknown_list.tsv.gz",
    5,
    _schema(("clade_name", S), ("ncbi_tax_id", S), ("relative_abundance", S)),
    {"relative_abundance": DOUBLE},
)
VIRUSES_LIST = Dataset(
    "metaphlan_viruses_list",
    "metaphlan_lists/metaphlan_viruses_list.tsv.gz",
    4,
    _schema(("mv_group_cluster", S), ("genome_name", S), ("length", L),
            ("breadth_of_coverage", D), ("mapping_reads_count", L), ("rpkm", D),
            ("depth_of_coverage_mean", D), ("depth_of_coverage_median", D),
            ("mv_group_type", S), ("assigned_taxonomy", S),
            ("first_genome_in_cluster", S), ("other_genomes_in_cluster", S)),
    {"length": LONG, "breadth_of_coverage": DOUBLE, "mapping_reads_count": LONG,
     "rpkm": DOUBLE, "depth_of_coverage_mean": DOUBLE, "depth_of_coverage_median": DOUBLE},
)

DATASETS: dict[str, Dataset] = {
    d.name: d for d in (MARKER_ABUNDANCE, MARKER_PRESENCE, MARKER_REL_AB, UNKNOWN_LIST, VIRUSES_LIST)
}

# Lookup table layouts.
SAMPLE_MAP_SCHEMA = _schema(("sample_id", S), ("run_ids", S), ("sample_name", S), ("study_name", S))
SAMPLE_MAP_TABLE = "src_sample_id_map"
ACCESSIONS_TABLE = "src_sra_accessions"
