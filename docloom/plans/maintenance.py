"""Size status of a document table's parts, and compaction of those whose deltas have grown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.plans.target import DocTable, Version


def part_status(table: DocTable) -> DataFrame:
    """`part, n_docs, n_files, base_bytes, delta_bytes` of the published version."""
    v = table.current()
    files = table.file_sizes().groupBy("part").agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum(F.when(F.col("kind") == "base", F.col("bytes"))), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum(F.when(F.col("kind") == "delta", F.col("bytes"))), F.lit(0)).alias("delta_bytes"),
    )
    key = F.col(v.id_column)
    docs = table.read().groupBy(F.pmod(key, F.lit(v.parts)).cast("int").alias("part")).agg(
        F.count("*").alias("n_docs")
    )
    return files.join(docs, "part", "left").select(
        "part", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "n_files", "base_bytes", "delta_bytes"
    )


def compaction_candidates(table: DocTable, max_delta_bytes: int) -> DataFrame:
    """Parts with more than `max_delta_bytes` in deltas; a limit of 0 turns compaction off."""
    sizes = table.file_sizes().where(F.col("kind") == "delta").groupBy("part").agg(F.sum("bytes").alias("delta_bytes"))
    return sizes.where((F.col("delta_bytes") > max_delta_bytes) & F.lit(max_delta_bytes > 0))


def compact_if_needed(table: DocTable, max_delta_bytes: int, max_deltas: int = 64) -> Version:
    """Compact the parts over the limit, then merge what is left of more than `max_deltas` change batches.

    The list of parts is configuration-sized.
    """
    parts = [r["part"] for r in compaction_candidates(table, max_delta_bytes).select("part").collect()]
    v = table.compact(parts)
    return table.merge_deltas() if len(v.delta) > max_deltas else v
