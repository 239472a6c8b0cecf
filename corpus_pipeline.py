"""A training corpus from `documents`: languages, exact copies, near copies, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet under the shared folder and
reread as the next stage's input, so a lost executor costs one stage's tasks at most. All stages but the last return the
columns of their input. Rows with null ids, texts, languages or sources, empty texts, repeated rows, empty tables and further
columns are handled as the operators' modules state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.bpe import encoded_rows
from docloom.llm.common import table, written
from docloom.llm.exact import drop_exact_copies
from docloom.llm.langid import drop_unidentified
from docloom.llm.mixing import mixed
from docloom.llm.simhash import drop_near_copies


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learnt languages go."""
    return drop_unidentified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space aside, the one with the smallest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 of their distinct five-word shingles, the one with the smallest id stays."""
    return drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' budgets draw them."""
    return mixed(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether decoding the ids gives the text again."""
    coded = encoded_rows(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("bpe", bpe),
]

#: Language ID and SimHash can't be expressed in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
