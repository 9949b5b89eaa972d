"""Dense row numbers of written files, without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY ...)`` with no partition key runs in one task. A row's number
here is its place in its file and the row counts of the files before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def file_row_numbers(files: DataFrame, order: Sequence[str], id_col: str, first: int = 1) -> DataFrame:
    """Number the rows of a scan of written files: files by ``order`` and path, rows by place.

    No sort and no staging copy of the rows: one pass counts rows per file (a
    map-side aggregate), the running sum over one row per file gives each
    file's offset, and a row adds its index in its file. Neither depends on
    how the scan is split, so a re-run task repeats its numbers exactly.
    """
    placed = files.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = placed.groupBy(*order, "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*order, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (placed.join(offsets, "_file")
            .withColumn(id_col, F.col("_offset") + F.col("_row") + first)
            .drop("_file", "_row", "_offset"))
