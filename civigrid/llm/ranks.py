"""Positions of all rows in one order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civigrid.llm.common import written

#: Bits that ``monotonically_increasing_id`` gives to a row's number within its partition.
ROW_BITS = 33


def numbered(rows: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """``rows`` (a written table, so that it reads the same each time) with their place in ``order``, from 0 and gapless.

    Rows are dealt by ranges of the order and sorted inside their partition, where the id that Spark counts up names the
    partition and the place in it; what earlier partitions hold is added from a table of one row for each partition.
    Rows that are equal in ``order`` are told apart by where they stand in the table, so any number of them is split over
    partitions. An empty table gives an empty one.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    kept = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_part", F.shiftright("_at", ROW_BITS))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = kept.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return kept.join(F.broadcast(starts), "_part").select(*rows.columns, place.alias(name))
