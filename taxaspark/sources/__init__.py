from taxaspark.sources.lookups import read_accessions, read_sample_map  # noqa: F401
from taxaspark.sources.raw import (  # noqa: F401
    dataset_glob,
    dataset_lines,
    read_files,
    parse_lines,
    scan_ext,
    scan_lines,
    scan_src,
)
from taxaspark.sources.tables import open_table, read_table, table_path  # noqa: F401
