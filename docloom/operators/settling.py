"""Replay of the settle window over a history: how the changes of each document were cut into batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCHES = "index string, doc_id bigint, batch_no bigint, first_us bigint, last_us bigint, n_rows bigint, flush_us bigint"


def settle_batches(
    changes: DataFrame, gap_seconds: int, hold_seconds: int, flush_seconds: int
) -> DataFrame:
    """Batches per (index, document) when the queue is flushed every `flush_seconds`.

    A flush takes a document that has been quiet for the gap or waiting for the hold; its next change starts a new
    batch.  Changes between two flushes are seen together, so they are first reduced to one row per document
    and flush tick, with map-side combining.  What follows is bounded by the ticks in the covered time, not by
    the number of rows: a stream over the sorted ticks that keeps one open batch.
    """
    tick_us = flush_seconds * 1_000_000
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    ticks = (
        changes.select("index", "doc_id", "seq", micros.alias("us"))
        .withColumn("tick", F.ceil(F.col("us") / F.lit(tick_us)))
        .groupBy("index", "doc_id", "tick")
        .agg(
            F.min_by("us", "seq").alias("first_us"),
            F.max("us").alias("last_us"),
            F.count("*").alias("n_rows"),
        )
    )
    ordered = ticks.repartition("index", "doc_id").sortWithinPartitions("index", "doc_id", "tick")
    gap_us, hold_us = gap_seconds * 1_000_000, hold_seconds * 1_000_000

    def ready_tick(first: int, last: int) -> int:
        return -(-min(last + gap_us, first + hold_us) // tick_us)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_batch = None  # [index, doc_id, batch_no, first_us, last_us, n_rows]
        for frame in frames:
            closed = []
            for index, doc_id, tick, first, last, n in zip(*(frame[c].tolist() for c in ticks_columns)):
                same_doc = open_batch is not None and open_batch[0] == index and open_batch[1] == doc_id
                if same_doc and ready_tick(open_batch[3], open_batch[4]) >= tick:
                    open_batch[4] = max(open_batch[4], last)
                    open_batch[5] += n
                    continue
                if open_batch is not None:
                    closed.append((*open_batch, ready_tick(open_batch[3], open_batch[4]) * tick_us))
                open_batch = [index, doc_id, open_batch[2] + 1 if same_doc else 0, first, last, n]
            if closed:
                yield pd.DataFrame(closed, columns=out_columns)
        if open_batch is not None:
            row = (*open_batch, ready_tick(open_batch[3], open_batch[4]) * tick_us)
            yield pd.DataFrame([row], columns=out_columns)

    ticks_columns = ["index", "doc_id", "tick", "first_us", "last_us", "n_rows"]
    out_columns = ["index", "doc_id", "batch_no", "first_us", "last_us", "n_rows", "flush_us"]
    return ordered.select(*ticks_columns).mapInPandas(cut, BATCHES)
