"""The queue of touched documents: settling, statistics and the safe resume position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doc_batches(changes: DataFrame) -> DataFrame:
    """One row per (index, document) of the queue.

    `first_ts` is the time of the first arrival, which need not be the earliest time; `last_ts` is the latest.
    The row changes stay where they are; the batch only keeps their range and number.  All changes of one feed
    position arrived together, so `seq` alone orders their times.
    """
    return changes.groupBy("index", "doc_id").agg(
        F.min_by("ts", "seq").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count("*").alias("n_rows"),
        F.min("event_id").alias("first_event_id"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )


def merge_batches(batches: DataFrame) -> DataFrame:
    """Batches of the same document from several arrivals as one."""
    return batches.groupBy("index", "doc_id").agg(
        F.min_by("first_ts", "first_seq").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.sum("n_rows").alias("n_rows"),
        F.min("first_event_id").alias("first_event_id"),
        F.min("first_seq").alias("first_seq"),
        F.max("last_seq").alias("last_seq"),
    )


def changes_of(changes: DataFrame, batches: DataFrame, index: str | None = None) -> DataFrame:
    """The row changes that belong to the given batches: same document, position within the batch's range.

    With `index`, all changes are of that index, which has one batch for each document, as `merge_batches` gives them, and
    changes that were dealt by document are not shuffled again.
    """
    span = batches.select(
        F.col("index").alias("_index"), F.col("doc_id").alias("_doc"), F.col("first_seq").alias("_from"),
        F.col("last_seq").alias("_to"),
    )
    mine = (F.col("doc_id") == F.col("_doc")) & F.col("seq").between(F.col("_from"), F.col("_to"))
    if index is None:
        return changes.join(span, (F.col("index") == F.col("_index")) & mine, "left_semi")
    # an inner join, as the optimizer would move a semi join below the dealing
    return changes.join(span.where(F.col("_index") == index), mine).select(*changes.columns)


def is_settled(now: Column, gap_seconds: float, hold_seconds: float) -> Column:
    """Quiet for `gap_seconds`, or waiting for `hold_seconds` since the first change."""
    def age(c):
        return F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(c).cast("timestamp"))

    return (age("last_ts") >= int(gap_seconds * 1e6)) | (age("first_ts") >= int(hold_seconds * 1e6))


def settle_split(batches: DataFrame, now: Column, gap_seconds: float, hold_seconds: float) -> DataFrame:
    """Batches with a `ready` flag; ready and waiting ones are complementary filters on it."""
    return batches.withColumn("ready", is_settled(now, gap_seconds, hold_seconds))


def queue_stats(batches: DataFrame) -> DataFrame:
    """Documents and row changes that wait per index."""
    return batches.groupBy("index").agg(F.count("*").alias("n_docs"), F.sum("n_rows").alias("n_rows"))


def safe_position(waiting: DataFrame, last_event_id: Column) -> DataFrame:
    """Position everything before which is applied: that of the oldest waiting change, else the last one seen."""
    return waiting.agg(F.coalesce(F.min("first_event_id"), last_event_id).alias("event_id"))
