"""Net differences of single values and of value sets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def net_plain_value(changes: DataFrame, keys: Sequence[str], order: str, old: str, new: str) -> DataFrame:
    """First old and last new value per key; keys that end where they began are dropped."""
    net = changes.groupBy(*keys).agg(
        F.min_by(old, order).alias("old_value"), F.max_by(new, order).alias("new_value")
    )
    return net.where(~F.col("old_value").eqNullSafe(F.col("new_value")))


STATES = ((-1, "_from_minus"), (0, "_from_zero"), (1, "_from_plus"))


def _step(state, delta):
    return F.greatest(F.lit(-1), F.least(F.lit(1), state + delta))


def _move(state, effect):
    return F.when(state < 0, effect["_from_minus"]).when(state > 0, effect["_from_plus"]).otherwise(effect["_from_zero"])


def net_set_value(
    changes: DataFrame, keys: Sequence[str], order: str, old: str, new: str, block: int = 65536, levels: int | None = None
) -> DataFrame:
    """Values added to or removed from a set per key, with cancellation: `keys, value, net` (1 added, -1 removed).

    Each change takes `old` out and puts `new` in, in that order; NULLs are ignored and so is a change to the same
    value.  Per value this is a counter kept within [-1, 1].  `order` must be a bigint that is unique per key.

    The counter is folded in blocks of `block` positions: a block's effect is where it takes each of the three
    counter states.  Effects are folded in blocks again, `levels` times in all, so a value that occurs in a third of
    all rows is spread over many groups, none longer than 2 * `block`.  By default there are as many levels as all
    positions of 63 bits need; fewer make the last fold longer if positions reach beyond `block` to that power.
    """
    if levels is None:
        levels = math.ceil(63 / math.log2(block))
    moved = changes.where(~F.col(old).eqNullSafe(F.col(new)))
    effects = moved.select(
        *keys,
        F.col(order).cast("bigint").alias("_at"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("_sub"), F.col(old).alias("value"), F.lit(-1).alias("_delta")),
                F.struct(F.lit(1).alias("_sub"), F.col(new).alias("value"), F.lit(1).alias("_delta")),
            )
        ),
    ).where(F.col("value").isNotNull())
    parts, follow = ("_sub", "_delta"), lambda s, x: _step(s, x["_delta"])
    for _ in range(levels - 1):
        steps = F.array_sort(F.collect_list(F.struct("_at", *parts))).alias("_steps")
        block_no = F.floor(F.col("_at") / F.lit(block)).alias("_block")
        effects = effects.groupBy(*keys, "value", block_no).agg(steps).select(
            *keys,
            "value",
            F.col("_block").alias("_at"),
            *[F.aggregate("_steps", F.lit(start), follow).alias(name) for start, name in STATES],
        )
        parts, follow = tuple(name for _, name in STATES), _move
    steps = F.array_sort(F.collect_list(F.struct("_at", *parts)))
    net = F.aggregate(steps, F.lit(0), follow).alias("net")
    return effects.groupBy(*keys, "value").agg(net).where(F.col("net") != 0)
