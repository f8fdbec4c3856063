"""Global positions without a single-partition window.

A result that is a list in an order (a ranking, a report by day) gets its
1-based position: rows are range partitioned on the order and sorted within
partitions; a row's position is its place in its partition plus the rows of the
partitions before it. Only the rows per partition (one number each) reach the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtest_spark.session import checkpoint_dir

_IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id: partition number above, place in it below


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """``df`` plus ``name``: the place of each row in ``order`` (long, from 1).

    Rows that are equal in ``order`` are next to each other in any order, so
    ``order`` should hold a key. The laid-out rows are checkpointed: their
    places must not change between the count and the result.
    """
    checkpoint_dir(df.sparkSession)
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_place", 33)
    sizes = laid.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()
    before, rows = 0, []
    for r in sorted(sizes, key=lambda r: r["_part"]):
        rows.append((r["_part"], before))
        before += r["_n"]
    # One row per partition of the layout: at most the number of shuffle partitions.
    offsets = df.sparkSession.createDataFrame(rows, "_part long, _before long")
    placed = laid.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    position = F.col("_before") + F.col("_place").bitwiseAND(F.lit(_IN_PARTITION)) + F.lit(1)
    return placed.select(*df.columns, position.alias(name))
