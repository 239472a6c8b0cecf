"""The commit history of document tables: positions, replica agreement, waiting for a position."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.coerce import part_of
from docloom.plans.target import DocTable

RECORD = (
    "version bigint, kind string, batch_id bigint, seq bigint, event_id bigint, build_id string, ts double, "
    "n_replace bigint, n_update bigint, n_delete bigint"
)


def commits(spark: SparkSession, tables: Mapping[str, DocTable]) -> DataFrame:
    """All recorded versions of the named tables: `target` and the fields of RECORD."""
    frames = []
    for name, table in tables.items():
        if table.versions():
            rows = spark.read.schema(RECORD).json(f"{table.root}/versions/*.json").where("version is not null")
            frames.append(rows.select(F.lit(name).alias("target"), "*"))
    if not frames:
        return spark.createDataFrame([], f"target string, {RECORD}")
    return reduce(DataFrame.unionByName, frames)


def current_positions(history: DataFrame) -> DataFrame:
    """The latest record per target."""
    fields = [c for c in history.columns if c != "target"]
    return history.groupBy("target").agg(F.max_by(F.struct(*fields), "version").alias("c")).select("target", "c.*")


def applied_up_to(history: DataFrame, seq: int) -> DataFrame:
    """Per target, whether position `seq` is applied; a caller that waits asks again."""
    return current_positions(history).select(
        "target", F.coalesce(F.col("seq") >= F.lit(seq), F.lit(False)).alias("applied")
    )


def replicas_agree(spark: SparkSession, tables: Mapping[str, DocTable]) -> DataFrame:
    """One row: do all targets have the same saved position?

    A target without a saved state counts as a state of its own, unless no target has one.
    """
    names = spark.createDataFrame([(n,) for n in tables], "target string")
    saved = current_positions(commits(spark, tables))
    state = F.coalesce(F.to_json(F.struct("seq", "event_id"), {"ignoreNullFields": "false"}), F.lit("none"))
    state = F.when(F.col("version").isNull(), F.lit("absent")).otherwise(state)
    return names.join(saved, "target", "left").agg(
        F.count_distinct(state).alias("n_states"), (F.count_distinct(state) <= 1).alias("agree")
    )


def content_digests(spark: SparkSession, tables: Mapping[str, DocTable]) -> DataFrame:
    """`target, part, n_docs, digest`: what each part of each target holds, in a form that no order of rows changes.

    Each document is hashed twice to 64 bits over all its columns, arrays in sorted order; a part's digest is the sums.
    Sums are combined before the shuffle, so a part is no task.
    """
    frames = []
    for name, table in tables.items():
        v = table.current()
        if v is None:
            continue
        docs = table.read(version=v.version)
        sets = {f.name for f in docs.schema.fields if isinstance(f.dataType, T.ArrayType)}
        values = [F.sort_array(f"`{c}`") if c in sets else F.col(f"`{c}`") for c in docs.columns]
        # a null is told from a value, and from the absence of a column, by its own hash
        cells = [F.struct(F.lit(c), x.isNull(), x) for c, x in zip(docs.columns, values)]
        sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
        per_part = docs.groupBy(part_of(F.col(f"`{v.id_column}`"), v.parts).cast("int").alias("part"))
        frames.append(
            per_part.agg(F.count(F.lit(1)).alias("n_docs"), F.concat_ws(":", *sums).alias("digest")).select(
                F.lit(name).alias("target"), "part", "n_docs", "digest"
            )
        )
    if not frames:
        return spark.createDataFrame([], "target string, part int, n_docs bigint, digest string")
    return reduce(DataFrame.unionByName, frames)


def parts_apart(spark: SparkSession, tables: Mapping[str, DocTable]) -> DataFrame:
    """`part, targets`: the parts whose content is not the same on all targets, and the digest and size each target has
    there (null where it has no document).  Empty if the replicas are equal."""
    found = content_digests(spark, tables)
    # a row for each part and target: configuration times the number of parts
    every = found.select("part").distinct().withColumn("target", F.explode(F.array(*[F.lit(n) for n in tables])))
    state = F.struct("target", "n_docs", "digest")
    known = F.coalesce("digest", F.lit("none"))
    return (
        every.join(found, ["target", "part"], "left")
        .groupBy("part")
        .agg(F.sort_array(F.collect_list(state)).alias("targets"), F.count_distinct(known).alias("n"))
        .where("n > 1")
        .select("part", "targets")
    )
