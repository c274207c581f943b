"""A total order over distributed rows, and files that keep it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

_PLACE_BITS = 33  # of the ids that Spark numbers rows by: the place in a partition, below the partition


def in_order(df: DataFrame, order_by: list[str | Column]) -> DataFrame:
    """The rows range-partitioned by the order and sorted within: partition by partition, they are in order.

    Equal rows may lie in one partition; a key with a large share of all rows is parted if the order has a column that tells its rows apart.
    """
    return df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)


def numbered(df: DataFrame, order_by: list[str | Column], name: str = "seq") -> DataFrame:
    """Add the place of each row in the total order, from 1, without a task that sees all rows.

    Rows that tie are numbered in some order. A row's place is its place in its partition plus the rows of the partitions before it;
    only partition sizes reach the driver. The sorted rows are checkpointed, so that a repeated task numbers them alike.
    """
    placed = cut(in_order(df, order_by).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", _PLACE_BITS), F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    before, starts = 0, []
    for row in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        starts.append((row.part, before))
        before += row.n
    first = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _before long"))
    return placed.withColumn("_part", part).join(first, "_part").select(*df.columns, (F.col("_before") + place + 1).alias(name))


def write_ordered(df: DataFrame, order_by: list[str | Column], path: str, *, source: str = "parquet") -> None:
    """Write the rows so that the files in order of their names, read from front to back, are in the total order."""
    in_order(df, order_by).write.mode("errorifexists").format(source).save(path)
