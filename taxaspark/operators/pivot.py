"""Long → wide pivot with one value per (index, column) cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def pivot_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values of ``column``: the column names of a pivot, so they are needed on the driver."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).collect()
    return [r[0] for r in rows]


def pivot_wide(df: DataFrame, index: str, column: str, value: str, values: list | None = None,
               cell: str = "unique") -> DataFrame:
    """One row per ``index``, one column per distinct ``column`` value.

    ``cell='unique'`` fails the job when a cell holds more than one row (as a
    pandas pivot refuses duplicate pairs); ``cell='sum'`` adds them up.
    Missing cells are NULL.  The duplicate check runs inside the aggregation,
    so no extra pass over the data is made.  ``values`` names the columns; a row of any other
    value fails the job.  Without it they are looked up first, an extra pass.
    """
    if cell == "unique":
        msg = F.concat(F.lit("duplicate pivot cell: "), F.col(index).cast("string"),
                       F.lit(" / "), F.col(column).cast("string"))
        cell_value = F.when(F.count(F.lit(1)) > 1, F.raise_error(msg)).otherwise(F.first(value))
    elif cell == "sum":
        cell_value = F.sum(value)
    else:
        raise ValueError("cell must be 'unique' or 'sum'")
    cells = df.groupBy(index, column).agg(cell_value.alias("_cell"))
    if values is None:
        values = pivot_values(df, column)
    else:
        other = F.col(column).isNotNull() & ~F.col(column).isin(values)
        unknown = F.raise_error(F.concat(F.lit("value without a pivot column: "), F.col(column).cast("string")))
        cells = cells.withColumn(column, F.when(other, unknown.cast("string")).otherwise(F.col(column)))
    return cells.groupBy(index).pivot(column, values).agg(F.first("_cell"))
