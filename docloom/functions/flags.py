"""Named boolean flags packed into bigint words.

A set of names that is fixed per plan (columns of a rule, attributes of an index) travels through shuffles as
one or more bigints.  `bit_or` over them has a fixed-width buffer, so the aggregation stays a code-generated hash
aggregate with map-side combining, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 62


def word_count(n_names: int) -> int:
    return max(1, -(-n_names // BITS))


def pack(names: Sequence[str], flags: Mapping[str, Column]) -> list[Column]:
    """One bigint per 62 names; bit i is set where the flag of name i is true."""
    words = []
    for w in range(word_count(len(names))):
        word = F.lit(0).cast("bigint")
        for bit, name in enumerate(names[w * BITS : (w + 1) * BITS]):
            if name in flags:
                word = word.bitwiseOR(F.when(flags[name], F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
        words.append(word)
    return words


def full(names: Sequence[str]) -> list[Column]:
    """The words with every name set."""
    return [
        F.lit((1 << len(names[w * BITS : (w + 1) * BITS])) - 1).cast("bigint")
        for w in range(word_count(len(names)))
    ]


def has(names: Sequence[str], words: Sequence[Column], name: str) -> Column:
    i = names.index(name)
    return words[i // BITS].bitwiseAND(F.lit(1 << (i % BITS)).cast("bigint")) != 0


def unpack(names: Sequence[str], words: Sequence[Column]) -> Column:
    """Array of the names that are set, in the order of `names`."""
    if not names:
        return F.array().cast("array<string>")
    picked = F.array(*[F.when(has(names, words, n), F.lit(n)) for n in names])
    return F.array_compact(picked)
