"""Exact dedup by content sort (DataFrame functions only).

Normalised texts are range-partitioned by sampled splitters, sorted externally, and compared in full with their
neighbours; of equal texts the row with the smallest id stays.

* The splitters are a short prefix, a hash of the text and a salt, so what is sampled stays small however long texts are,
  many texts with the same beginning still spread, and equal texts stay adjacent.
* A text that would fill more than half a partition is salted over as many partitions as its rows would fill. There are at
  most twice as many such texts as partitions. Their smallest id and size are aggregated before the shuffle.

Defined results: null text counts as empty; empty texts form a group; ties in the id keep one row; a null id sorts after
all others; an empty table gives an empty result; other columns never matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import SPACE, plain, shuffle_partitions

PREFIX = 48


def normal_text(text: str | Column = "text") -> Column:
    return F.regexp_replace(plain(text), SPACE, " ")


def _hot_texts(rows: DataFrame, parts: int) -> dict[int, int]:
    """Hash of each text that fills over half a partition -> partitions to spread it on; at most 2 * parts entries."""
    total = rows.count()
    if not total:
        return {}
    heavy = rows.groupBy("hash").count().where(F.col("count") * (2 * parts) > F.lit(total)).collect()
    return {r["hash"]: -(-r["count"] * parts // total) for r in heavy if r["count"] > 1}


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: `row` (a struct of its columns), `keep_id`, `group_size`, `kept`, `norm`."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        F.col(id_col).alias("id"),
        normal_text(text_col).alias("norm"),
    ).withColumn("hash", F.xxhash64("norm"))
    hot = _hot_texts(rows.select("hash"), parts)

    rows = rows.withColumn("prefix", F.substring("norm", 1, PREFIX))
    splitters = ["prefix", "hash"]
    if hot:
        spread = spark.createDataFrame(list(hot.items()), "hash bigint, salts bigint")
        salt = F.when(F.col("salts") > 1, F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).otherwise(0)
        rows = rows.join(F.broadcast(spread), "hash", "left").withColumn("salt", salt)
        splitters.append("salt")

    # the windows' keys begin with the splitters, so they work inside the ranges without another shuffle
    equal = Window.partitionBy(*splitters, "norm")
    runs = rows.repartitionByRange(*splitters).select(
        "*",
        F.row_number().over(equal.orderBy(F.col("id").asc_nulls_last())).alias("place"),
        F.min("id").over(equal).alias("run_min"),
        F.count(F.lit(1)).over(equal).alias("run_size"),
    )
    keep, size = F.col("run_min"), F.col("run_size")
    if hot:
        whole = (
            rows.where("salts is not null")
            .groupBy("norm")
            .agg(F.min("id").alias("hot_min"), F.count(F.lit(1)).alias("hot_size"))
            .select(F.sha2("norm", 256).alias("hot_sha"), "hot_min", "hot_size")
        )
        # as many rows as there are hot texts
        runs = runs.join(F.broadcast(whole), F.col("salts").isNotNull() & (F.sha2("norm", 256) == F.col("hot_sha")), "left")
        keep = F.when(F.col("hot_size").isNull(), keep).otherwise(F.col("hot_min"))
        size = F.coalesce("hot_size", "run_size")
    return runs.select(
        "row",
        keep.alias("keep_id"),
        size.alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep)).alias("kept"),
        "norm",
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    found = marked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return found.select("row.doc_id", "keep_id", "group_size", "kept", F.sha2("norm", 256).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    return marked(docs, id_col, text_col).where("kept").select("row.*")
