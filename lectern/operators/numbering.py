"""Numbering rows in order without bringing them together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.sources.scratch import written


def numbered(frame: DataFrame, order: Sequence[str], index: str = "index") -> DataFrame:
    """Add ``index``: a row's place, from 0, when all rows are sorted by ``order``.

    The rows are range-sorted once and written, which fixes the partitions. A place is the
    place in the partition plus the rows of the partitions before, so that only one row per
    partition is gathered. Put a unique column last in ``order``: equal keys share a partition.
    """
    # monotonically_increasing_id holds the partition in its upper and the place in its lower 33 bits.
    number = F.monotonically_increasing_id()
    sorted_rows = (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(number, 33).cast("int"))
        .withColumn("_place", number.bitwiseAND((1 << 33) - 1))
    )
    placed = written(sorted_rows, "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    # At most one row per partition.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(index, F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before")
    )
