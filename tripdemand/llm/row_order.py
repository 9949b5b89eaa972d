"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripdemand.llm.stored import written


def places(rows: DataFrame, order: list[Column], tree: str | None = None, tree_number: str | None = None) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in ``order``) and ``size`` (of how many); with ``tree``, among equal ones.

    ``tree_number`` names a column for the place of the row's tree among the trees (null first).

    Rows are dealt by ranges of ``tree`` and ``order``, so that a tree with a third of all
    rows is spread like any other, sorted and written once. What is summed up afterwards is
    one row for each partition and tree in it, and it is joined back by both, so no task
    has more than its partition. Rows that tie are numbered in any order. An
    empty table gives an empty one. Columns ``_at``, ``_part`` and ``_n`` are replaced.
    """
    of = [] if tree is None else [F.col(tree).asc_nulls_first()]
    ordered = rows.repartitionByRange(*of, *order).sortWithinPartitions(*of, *order)
    # the id is (partition, place in it)
    ordered = written(ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "ordered")
    keys = [] if tree is None else [tree]
    spans = ordered.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part")
    whole = Window.partitionBy(*keys)
    spans = spans.select(
        F.col("_part").alias("_span"), *(F.col(k).alias("_tree") for k in keys),
        (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size"),
    )
    if tree_number:
        numbers = places(spans.select(F.col("_tree").alias("_name")).distinct(), [F.col("_name").asc_nulls_first()])
        numbers = numbers.select("_name", F.col("pos").alias(tree_number))
        spans = spans.join(numbers, F.col("_tree").eqNullSafe(F.col("_name"))).drop("_name")
    spans = written(spans, "spans")
    same = F.col("_part") == F.col("_span")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_tree"))
    return ordered.join(spans, same).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_span", "_tree", "_shift", "_n")
