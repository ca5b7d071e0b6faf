"""Verification jobs: layer row counts, key uniqueness, provenance preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_layers(wide: DataFrame, names: list[str], extra_col: str | None = None,
                 extra: dict[int, str] | None = None) -> DataFrame:
    """One row with counts ``n0..nk`` → one row per layer with ``dropped`` vs the previous one.

    ``extra_col`` adds a column whose value per layer position is the SQL
    expression in ``extra`` (NULL where absent).
    """
    rows = []
    for i, name in enumerate(names):
        dropped = "cast(null as bigint)" if i == 0 else f"n{i - 1} - n{i}"
        row = f"{i}, '{name.replace(chr(39), chr(39) * 2)}', n{i}, {dropped}"
        if extra_col:
            row += f", cast({(extra or {}).get(i, 'null')} as bigint)"
        rows.append(row)
    cols = "position, layer, num_rows, dropped" + (f", {extra_col}" if extra_col else "")
    return wide.select(F.expr(f"stack({len(names)}, {', '.join(rows)}) as ({cols})"))


def layer_counts(layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """Row count of each layer (e.g. ext, src, stg) side by side.

    Columns: ``position``, ``layer``, ``num_rows`` and ``dropped`` (rows lost
    relative to the previous layer; NULL for the first).  Each count is a
    global aggregate (partial per task); the few counts are then folded into
    one row and stacked back, with no window and no join.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n")
             for i, (_, df) in enumerate(layers)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    wide = u.agg(*[F.max(F.when(F.col("i") == i, F.col("n"))).alias(f"n{i}") for i in range(len(layers))])
    return stack_layers(wide, [name for name, _ in layers])


def key_check(df: DataFrame, key: str, total_name: str = "total_rows",
              distinct_name: str | None = None) -> DataFrame:
    """One row: row count and distinct count of ``key`` (duplicates show as a gap)."""
    return df.agg(F.count(F.lit(1)).alias(total_name),
                  F.count_distinct(key).alias(distinct_name or f"distinct_{key}s"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def preview(df: DataFrame, n: int = 3, provenance: tuple[str, ...] = ("file_path", "sample_id")) -> DataFrame:
    """First ``n`` rows with their provenance columns in front."""
    front = [c for c in provenance if c in df.columns]
    rest = [c for c in df.columns if c not in front]
    return df.select(*front, *rest).limit(n)
