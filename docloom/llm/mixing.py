"""Mixing sources to target weights by temperature (DataFrame functions only).

A source with share p of the tokens gets a weight in proportion to p^a. The exponent a is the largest in [0, 1] at which the
weights' entropy reaches the target, found by bisection, then raised as far as needed so that no source is repeated more
often than the limit. The weights times the token budget are the sources' budgets, and they are realised as block
permutations: a source's documents lie in hashed blocks; each epoch takes whole blocks in an order of its own until the
budget is reached, and the block in which that happens gives its documents in a hashed order.

What passes through the driver is one row of sums for each step of the bisection. Running sums go over blocks, whose number
for a source is fixed, and over the documents of the one block in which a source's budget ends.

A text's tokens are its runs of non-space characters. Defined results: a null source is a source of its own; documents
without tokens use no budget and come once; repeated rows are drawn alike, and where the budget ends between them all or
none are taken; an empty table gives an empty result; other columns are kept and never clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import WORD, plain, written

STEPS = 32


@dataclass(frozen=True)
class Mix:
    entropy_share: float = 0.9  # least entropy, as a share of the sources' highest
    most_epochs: float = 4.0
    budget_share: float = 1.0  # tokens to draw, as a share of those there are
    blocks: int = 256  # of each source
    seed: str = "mix"


def n_tokens(text: str | Column) -> Column:
    return F.regexp_count(plain(text), F.lit(WORD)).cast("long")


def _draw(*parts: Column | str) -> Column:
    """A number of 28 bits that the parts decide."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 7), 16, 10).cast("long")


def _bisect(sources: DataFrame, low: float, high: float, sums, stays_low) -> tuple[float, float]:
    """Halve [low, high] STEPS times, raising its low end where `stays_low` holds. Four halvings share a pass over the
    sources, which sums at all the midpoints that they can ask for."""
    for _ in range(0, STEPS, 4):
        mids = [low + (high - low) * i / 16 for i in range(1, 16)]
        row = sources.agg(*(c.alias(f"{k}{i}") for i, a in enumerate(mids) for k, c in sums(a).items())).first()
        at, step = 0, 8
        while step:
            i = at + step - 1
            if stays_low(mids[i], {k: row[f"{k}{i}"] for k in sums(0.0)}):
                at += step
            step //= 2
        low, high = low + (high - low) * at / 16, low + (high - low) * (at + 1) / 16
    return low, high


def exponent(sources: DataFrame, mix: Mix) -> float:
    """The exponent for `sources`, which has the column `share`."""
    n = sources.count()
    if n < 2:
        return 1.0
    p = F.col("share")

    def entropy_sums(a: float) -> dict[str, Column]:
        w = F.pow(p, F.lit(a))
        return {"z": F.sum(w), "l": F.sum(w * F.ln(p))}

    def even_enough(a: float, s: dict) -> bool:  # entropy falls as the exponent rises
        return math.log(s["z"]) - a * s["l"] / s["z"] >= mix.entropy_share * math.log(n)

    def repeat_sums(a: float) -> dict[str, Column]:
        return {"z": F.sum(F.pow(p, F.lit(a))), "r": F.max(F.pow(p, F.lit(a - 1.0)))}

    def too_often(a: float, s: dict) -> bool:  # the rarest source is drawn less as the exponent rises
        return mix.budget_share * s["r"] / s["z"] > mix.most_epochs

    top = sources.agg(*(c.alias(k) for k, c in entropy_sums(1.0).items())).first().asDict()
    a = 1.0 if even_enough(1.0, top) else _bisect(sources, 0.0, 1.0, entropy_sums, even_enough)[0]
    at = sources.agg(*(c.alias(k) for k, c in repeat_sums(a).items())).first().asDict()
    if too_often(a, at):
        a = _bisect(sources, a, 1.0, repeat_sums, too_often)[1]
    return round(a, 6)


def weights(sources: DataFrame, mix: Mix) -> DataFrame:
    """source, tokens, weight, budget (tokens to draw), epochs (whole ones), rest (tokens of the last one)."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    a = exponent(shares, mix)
    z = shares.agg(F.sum(F.pow("share", F.lit(a)))).first()[0] or 1.0
    weight = F.pow("share", F.lit(a)) / F.lit(z)
    return (
        shares.withColumn("weight", weight)
        .withColumn("budget", F.floor(F.round(F.col("weight") * F.lit(mix.budget_share * total), 3)))
        .withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .select("source", "tokens", "weight", "budget", "epochs", "rest")
    )


def _draws(docs: DataFrame, mix: Mix, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """`row` (a struct of the columns), source, id, tokens, block; a row for each row and epoch that draws it: epoch, spot."""
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        n_tokens(text_col).alias("tokens"),
    ).withColumn("block", F.pmod(_draw(F.lit(mix.seed), "id"), F.lit(mix.blocks)).cast("int"))
    # tokens of each block of each source: all that follows reads these few sums
    blocks = written(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    plan = written(weights(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), mix), "mix-plan")

    last = blocks.join(plan.select(F.col("source").alias("s"), "epochs", "rest"), F.col("source").eqNullSafe(F.col("s")))
    order = _draw(F.lit(mix.seed), F.col("source"), F.col("epochs").cast("string"), F.col("block").cast("string"))
    before = F.sum("tokens").over(
        Window.partitionBy("source").orderBy("spot", "block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = last.withColumn("spot", order).withColumn("before", F.coalesce(before, F.lit(0)))
    blocks = blocks.select(
        F.col("source").alias("s"),
        F.col("block").alias("b"),
        "epochs",
        (F.col("rest") - F.col("before")).alias("room"),
        F.col("tokens").alias("block_tokens"),
    )
    # sources x blocks rows: Spark broadcasts them if they are few
    rows = rows.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    rows = rows.withColumns({"epochs": F.coalesce("epochs", F.lit(1)), "room": F.coalesce("room", F.lit(0))})

    ends = (F.col("room") > 0) & (F.col("room") < F.col("block_tokens"))
    inner = _draw(F.lit(mix.seed), F.lit("in"), "id")
    # only rows of the blocks in which a budget ends are summed in order
    cut = (
        rows.where(ends)
        .select("source", "block", "id", "tokens", "room", inner.alias("spot"))
        .groupBy("source", "block", "id", "room", "spot")
        .agg(F.sum("tokens").alias("tokens"))
    )
    upto = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("spot", "id"))
    cut = cut.withColumn("upto", upto).where("upto <= room").select(F.col("source").alias("cs"), F.col("id").alias("cid"))
    taken = rows.where(ends).join(cut, F.col("source").eqNullSafe(F.col("cs")) & (F.col("id") == F.col("cid")), "left")
    taken = taken.select("row", "source", "id", "tokens", "block", (F.col("epochs") + F.col("cid").isNotNull().cast("int")).alias("times"))
    whole = rows.where(~ends | ends.isNull()).select(
        "row", "source", "id", "tokens", "block",
        (F.col("epochs") + ((F.col("room") > 0) & (F.col("room") >= F.col("block_tokens")) & (F.col("tokens") > 0)).cast("int")).alias("times"),
    )
    drawn = whole.unionByName(taken).withColumn(
        "times", F.when(F.col("tokens") == 0, F.lit(1)).otherwise(F.col("times")).cast("int")
    )
    return drawn.where("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))


def mixture(docs: DataFrame, mix: Mix = Mix(), id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, place: each draw of a row. (epoch, place) orders a source's draws."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    place = F.concat_ws(
        ".",
        F.lpad(_draw(F.lit(mix.seed), F.col("source"), F.col("epoch").cast("string"), F.col("block").cast("string")), 9, "0"),
        F.lpad("block", 6, "0"),
        F.lpad(_draw(F.lit(mix.seed), F.lit("in"), "id"), 9, "0"),
    )
    draws = _draws(docs, mix, "doc_id", "text", "source")
    return draws.select(
        "row.doc_id", "source", F.col("tokens").alias("n_tokens"), F.col("epoch"), F.col("block"), place.alias("place")
    )


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The rows of `docs`, each as often as it is drawn."""
    return _draws(docs, mix, id_col, text_col, source_col).select("row.*")
