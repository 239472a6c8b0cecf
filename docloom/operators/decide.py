"""What to do with each changed document: delete it, update attributes in place, or replace it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.coerce import part_of


def decide(
    changed: DataFrame, documents: DataFrame, id_column: str, in_place: Sequence[str], parts: int
) -> DataFrame:
    """Changed documents (`doc_id, attrs`) with their current content and an action.

    Not in the source any more: delete.  Only in-place attributes changed: update.  Anything else: replace.
    The result is `doc_id, part, action, attrs, doc`, where `doc` holds the other document columns.
    """
    content = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != id_column])
    current = documents.select(F.col(id_column).alias("_id"), content.alias("doc"))
    in_place_only = F.size(F.array_except("attrs", F.array(*[F.lit(a) for a in in_place]).cast("array<string>"))) == 0
    action = (
        F.when(F.col("_id").isNull(), F.lit("delete"))
        .when(in_place_only, F.lit("update"))
        .otherwise(F.lit("replace"))
    )
    return changed.join(current, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", part_of(F.col("doc_id"), parts).alias("part"), action.alias("action"), "attrs", "doc"
    )


def actions_per_part(decided: DataFrame) -> DataFrame:
    return decided.groupBy("part", "action").agg(F.count("*").alias("n_docs"))
