"""Phrase collocations from FM-indexes: one per shard over word ids, n-grams by extending intervals, counts summed over shards.

A shard holds the word ids of about `SHARD` words of one language, 0 between pieces. Its index has two halves, one over the
text and one over the text reversed, each a Burrows-Wheeler transform in the order of as many words as phrases need. Words are
intervals of either half; extending all of them to the left in the first half gives the phrases of two words, and, as an
interval's extensions lie in word order in the other half, their intervals there. Extending those to the right gives phrases
of three words, and so on: an interval's size is the phrase's count in the shard.

Phrases are counted a length at a time. A phrase can be frequent only if its parts are, so before each round words or phrases
that aren't are cut out of the shards' texts, by a bit table of fixed size that may let some through. Counts of what is left
are summed over all shards by Spark and are exact; the bit table decides the cost only. A text of any length is read
piecewise, and a shard that would grow beyond its size is indexed in slices that overlap by less than a phrase.

Defined results: null text counts as empty, null language is `und`; ids are not read, so rows that repeat an id or have none
count like others, and repeated rows count each time; ties are broken as the order says, to the phrase's bytes; an empty table
gives an empty result; other columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import discard, written

#: Words of a shard, roughly.
SHARD = 1 << 20
#: Bytes of a text that are cut into words at once, roughly; bytes of phrases given to Spark at once, roughly.
CHUNK = 1 << 20
#: The bit table has 2^TABLE_BITS bits: 8 MB, whatever the corpus.
TABLE_BITS = 26
#: Groups that a language's candidates are ranked in before they are ranked together.
SALTS = 64

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
AS_STOP = bytes.maketrans(SEPARATORS, b"." * len(SEPARATORS))
MIX = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- words


class Numbered(dict):
    """Word -> number, in the order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Shard:
    """Word numbers of texts of one language. The stop that stands for all separators has number 0."""

    def __init__(self):
        self.numbers = Numbered({b".": 0})
        self.parts = [np.zeros(1, dtype=np.int32)]

    def add(self, text: str) -> int:
        """Append a text and say how many words and stops it has."""
        data, at, size = text.encode("utf-8", "replace"), 0, 1
        while at < len(data):
            end = data.find(b" ", at + CHUNK)
            end = len(data) if end < 0 else end
            # what split() cuts at beside the blank and the tab has become a stop
            tokens = data[at:end].lower().translate(AS_STOP).replace(b".", b" . ").split()
            self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
            size += len(tokens)
            at = end
        self.parts.append(np.zeros(1, dtype=np.int32))
        return size

    def text(self) -> np.ndarray:
        self.parts = [np.concatenate(self.parts)]
        return self.parts[0]


# ---------------------------------------------------------------- the index


class Half:
    """One direction of the index: rows in the order of the next `depth` words, with the word before each."""

    def __init__(self, text: np.ndarray, n_words: int, depth: int):
        key = text.astype(np.int64)
        for j in range(1, depth):
            key *= n_words
            key[:-j] += text[j:]
        self.before = text[np.argsort(key, kind="stable") - 1]
        self.inverse = np.argsort(self.before, kind="stable")  # row of the extended suffix -> row of the suffix
        self.words = self.before[self.inverse]

    def extend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(index of the interval, word put before it, low, high) of all extensions, in word order, stops included."""
        owner = np.full(len(self.before), -1, dtype=np.int64)
        size = high - low
        first = np.cumsum(size) - size
        owner[np.repeat(low - first, size) + np.arange(size.sum())] = np.repeat(np.arange(len(low)), size)
        owner = owner[self.inverse]
        start = np.concatenate([[0], np.flatnonzero((owner[1:] != owner[:-1]) | (self.words[1:] != self.words[:-1])) + 1])
        end = np.concatenate([start[1:], [len(owner)]])
        some = owner[start] >= 0
        return owner[start][some], self.words[start][some], start[some], end[some]


def phrases_of(text: np.ndarray, n_words: int, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The words, a column for each place, and counts of all phrases of `depth` words; `text` begins and ends with 0."""
    counts = np.bincount(text, minlength=n_words)
    ends = np.cumsum(counts)
    word = np.flatnonzero(counts)
    word = word[word > 0]
    if depth == 1 or not len(word):
        return [word] * depth, counts[word]
    low, high = ends[word] - counts[word], ends[word]
    owner, left, start, end = Half(text, n_words, 1).extend(low, high)
    size = end - start
    order = np.argsort(owner, kind="stable")  # an interval's extensions together, in word order as in the other half
    before = np.cumsum(size[order]) - size[order]
    first = np.concatenate([[True], owner[order][1:] != owner[order][:-1]])
    before -= np.repeat(before[first], np.diff(np.concatenate([np.flatnonzero(first), [len(order)]])))
    low = np.empty_like(start)
    low[order] = ends[word[owner[order]]] - counts[word[owner[order]]] + before
    inside = left > 0
    columns, low, size = [left[inside], word[owner[inside]]], low[inside], size[inside]
    if depth > 2:
        half = Half(text[::-1], n_words, depth - 1)
        for _ in range(depth - 2):
            owner, right, start, end = half.extend(low, low + size)
            inside = right > 0
            owner, low, size = owner[inside], start[inside], (end - start)[inside]
            columns = [*(c[owner] for c in columns), right[inside]]
    return columns, size


def mixed_hashes(words: list[np.ndarray]) -> np.ndarray:
    """A hash of each phrase from the hashes of its words, a column for each place."""
    out = reduce(lambda h, w: (h ^ (h >> np.uint64(29))) * MIX + w, words)
    return (out ^ (out >> np.uint64(32))) * MIX


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "replace"))
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def pruned(text: np.ndarray, hashes: np.ndarray, table: np.ndarray, depth: int) -> np.ndarray:
    """The stretches of `text` in which all phrases of `depth` words are in the table and that hold more than one."""
    n = len(text) - depth + 1
    windows = [text[j : j + n] for j in range(depth)]
    slot = mixed_hashes([hashes[w] for w in windows]) >> np.uint64(64 - TABLE_BITS)
    good = (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
    for w in windows:
        good &= w > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
    start, size = edge[::2], edge[1::2] - edge[::2]
    start, size = start[size > 1], size[size > 1] + depth - 1
    # each stretch and a stop
    first = np.cumsum(size + 1) - size
    out = np.zeros(int((size + 1).sum()) + 1, dtype=text.dtype)
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out[at] = text[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    return out


# ---------------------------------------------------------------- counts over all shards


def shard_counts(docs: DataFrame, depth: int, table: np.ndarray | None, lang_col: str, text_col: str) -> DataFrame:
    """(lang, phrase, n) of each shard; with depth 1 also a row without phrase, the number of words."""
    shared = None if table is None else docs.sparkSession.sparkContext.broadcast(table)

    def give(lang: str, shard: Shard) -> Iterator[pa.RecordBatch]:
        text, words = shard.text(), list(shard.numbers)
        if depth > 1:
            text = pruned(text, word_hashes(words, lang), shared.value, depth - 1)
        names, lengths = pa.array(words, pa.binary()), np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        if depth == 1:
            yield pa.record_batch([pa.array([lang]), pa.array([None], pa.string()), pa.array([int((text > 0).sum())])], names=["lang", "phrase", "n"])
        for at in range(0, max(len(text) - 1, 0), SHARD):
            some = np.concatenate([[0], text[at : at + SHARD + depth - 1], [0]]).astype(text.dtype)
            columns, n = phrases_of(some, len(words), depth)
            heap = np.cumsum(sum(lengths[c] for c in columns)) // CHUNK
            for part in np.split(np.arange(len(n)), np.flatnonzero(np.diff(heap)) + 1):
                taken = [pc.take(names, pa.array(c[part])) for c in columns]
                phrase = (pc.binary_join_element_wise(*taken, b" ") if depth > 1 else taken[0]).cast(pa.string())
                yield pa.record_batch([pa.array([lang] * len(part), pa.string()), phrase, pa.array(n[part], pa.int64())], names=["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                size += shards.setdefault(lang, Shard()).add(text.as_py())
                if size >= SHARD:
                    for item in shards.items():
                        yield from give(*item)
                    shards, size = {}, 0
        for item in shards.items():
            yield from give(*item)

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text is not null")
    return rows.mapInArrow(run, "lang string, phrase string, n bigint")


def bit_table(grams: DataFrame) -> np.ndarray:
    """Bits of the hashes of (lang, phrase), in a table of fixed size."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[list[bytes]]] = {}
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(phrase.encode().split(b" "))
            for lang, some in by_lang.items():
                slot = mixed_hashes([word_hashes(list(c), lang) for c in zip(*some)]) >> np.uint64(64 - TABLE_BITS)
                bits = (np.uint64(1) << (slot & np.uint64(63))).view(np.int64)
                yield pa.record_batch([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bits)], names=["at", "bits"])

    marked = grams.select("lang", "phrase").mapInArrow(mark, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    found = marked.toArrow()  # at most 2^TABLE_BITS / 64 rows
    table = np.zeros(1 << (TABLE_BITS - 6), dtype=np.uint64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> list[DataFrame]:
    """(lang, phrase, n) of all phrases that occur `least` times or more, written, a table for each number of words. The first
    has also a row without phrase for each language, the number of its words."""
    out, table = [], None
    for depth in range(1, longest + 1):
        counted = shard_counts(docs, depth, table, lang_col, text_col).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        out.append(written(counted.where((F.col("n") >= least) | F.col("phrase").isNull()), f"phrases-{depth}"))
        if depth < longest:
            table = bit_table(out[-1].where("phrase is not null"))
    return out


# ---------------------------------------------------------------- collocations


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    share: int = 50,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` candidates. A candidate occurs `least` times or more;
    its score is that of its weakest cut in two, floor(10^6 a^2 / (l r)); one that `share` percent or more of the time stands
    inside a longer candidate gives way."""
    words, *longer = phrase_counts(docs, longest, least, lang_col, text_col)
    total = words.where("phrase is null").select(F.col("lang").alias("lang"), F.col("n"))
    grams = reduce(DataFrame.unionByName, [words.where("phrase is not null"), *longer])
    found = reduce(DataFrame.unionByName, longer).select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    def joined(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    at = F.col("k").cast("int")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), at).alias("first"), joined(at + 1, F.size("w") - at).alias("rest"))
    part = grams.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rest = grams.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(part, ["lang", "first"]).join(rest, ["lang", "rest"])
    exact = "cast({} as decimal(18,0))"
    score = F.expr(f"({exact.format('a')} * {exact.format('a')} * 1000000) div ({exact.format('l')} * {exact.format('r')})")
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    size = F.col("size").cast("int")
    inside = found.withColumn("size", F.explode(F.when(F.size("w") > 2, F.sequence(F.lit(2), F.size("w") - 1))))
    inside = inside.withColumn("start", F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)))
    inside = inside.groupBy("lang", joined(F.col("start"), size).alias("phrase")).agg(F.max("a").alias("most"))
    stays = F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))
    scored = weakest.join(inside, ["lang", "phrase"], "left").where(stays).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.drop("salt").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    best = written(ranked.where(F.col("rank") <= top).join(total, "lang"), "collocations")
    discard(words, *longer)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
