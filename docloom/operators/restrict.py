"""Cut tables down to a set of ids without shuffling them: a semi join on bits of the ids' hashes.

The ids become a table of bit words, `2^(BITS - 6)` rows at most whatever their number, which every task of a scan holds.
Rows whose bit is not set belong to no id; a few others pass by chance.  So whatever is made per id of the rows that pass
is right for the ids, and what was made for others is dropped from the result, by an exact join on its ids.  Rows
stay where they were read: what follows can combine them before the first shuffle, so one id may own any share of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the table: 2^25, in 2^19 words of about 16 MB.
BITS = 25


def _spot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.try_cast("bigint")), F.lit(1 << BITS))


def _place(spot: Column) -> Column:
    return spot.bitwiseAND(F.lit(63)).cast("int")


def bit_words(ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """(_at, _bits): the words of the bit table in which some bit is set."""
    spot = ids.select(_spot(F.col(column)).alias("_spot"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(F.col("_spot")))
    return spot.groupBy(F.shiftright("_spot", 6).alias("_at")).agg(F.bit_or(bit).alias("_bits"))


def possible(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """The rows whose key's bit is set.  The words are bounded by `BITS`, so they are always broadcast."""
    spot = _spot(F.col(key))
    bit = F.call_function("shiftright", F.col("_bits"), _place(spot)).bitwiseAND(F.lit(1))
    return rows.join(F.broadcast(words), (F.shiftright(spot, 6) == F.col("_at")) & (bit == 1), "left_semi")


def is_small(rows: DataFrame) -> bool:
    """Whether Spark, going by its own estimate of the size, broadcasts `rows` to what it joins them with."""
    limit = rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def semi(rows: DataFrame, key: str, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose key is among the ids.  Many ids cut the rows down by their bits first, so that others aren't shuffled."""
    if not is_small(ids):
        rows = possible(rows, key, bit_words(ids, column))
    wanted = ids.select(F.col(column).alias("_wanted"))
    return rows.join(wanted, F.col(key) == F.col("_wanted"), "left_semi")


def anti(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key is not among the ids, which have it as their only column, under the same name.

    With many ids the keys alone are compared first, and only rows that may stay are shuffled as a whole.
    """
    if not is_small(ids):
        rows = possible(rows, key, bit_words(rows.select(key).join(ids, key, "left_anti"), key))
    return rows.join(ids, key, "left_anti")
