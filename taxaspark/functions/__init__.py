from taxaspark.functions.columns import (  # noqa: F401
    gt_not_nan,
    lenient_double,
    lenient_long,
    min_nan_first,
    null_sentinel,
    ordered_string_agg,
    sample_id_from_path,
    sample_id_pattern,
)
