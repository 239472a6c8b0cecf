"""How far each target is behind its feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.rules import TableFeed
from docloom.plans.commits import commits, current_positions
from docloom.plans.target import DocTable


def sync_status(
    spark: SparkSession, tables: Mapping[str, DocTable], feeds: Sequence[TableFeed], now: Column
) -> DataFrame:
    """Per target: read and upstream position, row changes still to apply, seconds since the last row change.

    The targets' positions are a row each; one pass over the feeds counts for all of them.
    """
    history = commits(spark, tables)
    totals = history.groupBy("target").agg(
        F.count_if(F.col("kind").startswith("apply")).alias("n_batches"),
        F.sum(F.when(F.col("kind").startswith("apply"), F.col("n_replace"))).alias("n_replace"),
        F.sum(F.when(F.col("kind").startswith("apply"), F.col("n_update"))).alias("n_update"),
        F.sum(F.when(F.col("kind").startswith("apply"), F.col("n_delete"))).alias("n_delete"),
    )
    positions = {r["target"]: r["seq"] for r in current_positions(history).select("target", "seq").collect()}
    rows = reduce(DataFrame.unionByName, [f.df.select("seq", "ts") for f in feeds])
    waiting = [
        F.count_if(F.lit(True) if p is None else F.col("seq") > p).alias(f"w{i}")
        for i, p in enumerate(positions.values())
    ]
    upstream = rows.agg(F.max("seq").alias("feed_seq"), F.max("ts").alias("feed_ts"), *waiting)
    per_target = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(t).alias("target"), F.lit(p).cast("bigint").alias("seq"), F.col(f"w{i}").alias("n_waiting")
                )
                for i, (t, p) in enumerate(positions.items())
            ]
        )
    )
    lag = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("feed_ts").cast("timestamp"))) / 1e6
    return (
        upstream.select(per_target.alias("t"), "feed_seq", lag.alias("lag_seconds"))
        .select("t.*", "feed_seq", "lag_seconds")
        .join(totals, "target")
    )
