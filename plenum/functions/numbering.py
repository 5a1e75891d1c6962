"""Consecutive numbers in a given order without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plenum.session import materialize


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, … following ``order``, a total order.

    A range sort puts rows in sorted partitions; the written table fixes them. Partition counts, one row per
    partition, then give each partition its offset.
    """
    low_bits = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in these
    placed = materialize(
        df.sort(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(low_bits))),
        "numbered",
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_part", "_row", "_offset")
    )
