"""Positions in the feed: tagging rows with the last position marker, and resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import staged


def tag_positions(feed: DataFrame, is_marker: Column, order: str = "seq", block: int | None = None) -> DataFrame:
    """Give every row the number of position markers before or at it, as `event_id`.  Rows without a position come first.

    A running count over one global order would pass the feed through a single task.  Here the feed is dealt into ranges
    of `order` with about equally many rows, however sparse its positions are: `block` rows each, or as many ranges as
    Spark's shuffles have.  Each range counts for itself; what is summed up in global order is one number per range.
    """
    rows = feed.withColumn("_marker", F.when(is_marker, 1).otherwise(0))
    if block is None:
        dealt = rows.repartitionByRange(order)
    else:
        dealt = rows.repartitionByRange(max(1, -(-feed.count() // block)), order)
    # written, so that ranges stay what they are whatever is computed again
    dealt = staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    per_range = dealt.groupBy("_range").agg(F.sum("_marker").alias("_n"))
    # a row for each range
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_range.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.sum("_marker").over(
        Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        dealt.withColumn("_within", within)
        .join(offsets, "_range")
        .withColumn("event_id", F.col("_before") + F.col("_within"))
        .drop("_marker", "_range", "_before", "_within")
    )


def resume_after(feed: DataFrame, seq: int | None) -> DataFrame:
    """The feed after a position; without one, all of it."""
    return feed if seq is None else feed.where(F.col("seq") > seq)


def already_applied(feed: DataFrame, seq: int) -> DataFrame:
    return feed.where(F.col("seq") <= seq)
