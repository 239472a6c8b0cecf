"""Substring dedup by relative Lempel-Ziv parsing.

A window of `window` consecutive words is a duplicate if its words also start anywhere else. Reference blocks of `BLOCK` words
are picked by content (winnowing), so that every window holds at least one and equal windows hold the same ones. All blocks
are indexed by hash with their first place in the corpus, the reference.

Each document with a block that occurs twice is then factored: following its blocks from left to right, a factor goes on as
long as the next block's first place is the next block of the same reference, and the words in between agree; otherwise the
next factor begins. Windows inside a factor that is not its own reference are duplicates, in the document and in the
reference. Windows across factor boundaries, and those of the references themselves, are compared by their hash of 128
bits. So what is compared window by window is each passage's reference and the boundaries, not all its copies.

Removed words are found from sums of +1 and -1 at the ends of duplicate stretches, which are combined before the shuffle, so
a reference that a third of all documents repeat gets no more sums than it has words.

Defined results: null and empty texts have no words; nothing is removed from documents shorter than a window; rows that
repeat an id are documents of their own; rows that are equal in id and text are copies of each other; a null id is an id;
an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import SPACE, WORD, discard, plain, written

WINDOW = 35
BLOCK = 8
NO_ID = -(1 << 63)
#: Odd multipliers of two polynomial hashes modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class Powers:
    """Powers of the bases and of their inverses, as far as a document needs them."""

    def __init__(self):
        self.up = [np.ones(1, dtype=np.uint64) for _ in BASES]
        self.down = [np.ones(1, dtype=np.uint64) for _ in BASES]

    def reach(self, n: int) -> None:
        if len(self.up[0]) >= n:
            return
        size = max(n, 2 * len(self.up[0]), 4096)
        for i, base in enumerate(BASES):
            for table, x in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                full = np.full(size, x, dtype=np.uint64)
                full[0] = 1
                table[i] = np.multiply.accumulate(full)


POWERS = Powers()


def word_hashes(text: str | None) -> tuple[list[bytes], np.ndarray]:
    words = (text or "").encode("utf-8", "replace").split()  # splits at the six ASCII spaces
    digest = xxhash.xxh3_64_intdigest
    return words, np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


class Stretches:
    """Hashes of any stretch of a document's words."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        POWERS.reach(n + 1)
        self.sums = []
        for up in POWERS.up:
            s = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(hashes * up[:n], out=s[1:])
            self.sums.append(s)

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        s = self.sums[which]
        h = (s[end] - s[start]) * POWERS.down[which][start] + (end - start).astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * MIX
        return h ^ (h >> np.uint64(29))


def blocks_of(stretches: Stretches, n: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the blocks: in each run of windows' worth of blocks the rightmost of least hash."""
    w = window - BLOCK + 1
    if n < window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    at = np.arange(n - BLOCK + 1)
    h = stretches.of(at, at + BLOCK)
    picked = np.zeros(len(h), dtype=bool)
    step = 1 << 16
    for s in range(0, len(h) - w + 1, step):
        view = np.lib.stride_tricks.sliding_window_view(h[s : s + step + w - 1], w)
        picked[s + np.arange(len(view)) + w - 1 - view[:, ::-1].argmin(axis=1)] = True
    places = np.flatnonzero(picked)
    return places, h[places]


def links_of(stretches: Stretches, places: np.ndarray) -> np.ndarray:
    """Hash of the words from each block to the end of the next one; 0 for the last."""
    out = np.zeros(len(places), dtype=np.uint64)
    out[:-1] = stretches.of(places[:-1], places[1:] + BLOCK)
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (the id), part (64 bits of the text's hash, so that rows repeating an id stay apart), text."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        plain(text_col).alias("text"),
    ).withColumn("part", F.xxhash64("text"))


def block_rows(docs: DataFrame, window: int) -> DataFrame:
    """(hash, link, doc, part, pos) of every block."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                out = []
                for doc, part, text in zip(some.column(0).to_numpy(), some.column(1).to_numpy(), some.column(2).to_pylist()):
                    words, hashes = word_hashes(text)
                    if len(words) < window:
                        continue
                    stretches = Stretches(hashes)
                    places, h = blocks_of(stretches, len(words), window)
                    link = links_of(stretches, places)
                    out.append((h.view(np.int64), link.view(np.int64), np.full(len(h), doc), np.full(len(h), part), places))
                if out:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names=["hash", "link", "doc", "part", "pos"])

    return docs.select("doc", "part", "text").mapInArrow(find, "hash bigint, link bigint, doc bigint, part bigint, pos bigint")


def parse(
    places: np.ndarray, links: np.ndarray, own: tuple[int, int], shared: np.ndarray, refs: dict[str, np.ndarray], window: int
) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """Greedy factors (start, end, reference's doc and part, its start) of at least a window that lie elsewhere, and the shared
    blocks. `shared` are indexes into `places` and `refs` holds doc, part, pos and link of each one's first place."""
    doc, part = own
    first = np.flatnonzero(
        np.concatenate(
            [
                [True],
                (shared[1:] != shared[:-1] + 1)
                | (refs["doc"][1:] != refs["doc"][:-1])
                | (refs["part"][1:] != refs["part"][:-1])
                | (refs["pos"][1:] - refs["pos"][:-1] != places[shared[1:]] - places[shared[:-1]])
                | (refs["link"][:-1] != links[shared[:-1]]),
            ]
        )
    )
    last = np.concatenate([first[1:], [len(shared)]]) - 1
    start, end = places[shared[first]], places[shared[last]] + BLOCK
    elsewhere = (refs["doc"][first] != doc) | (refs["part"][first] != part) | (refs["pos"][first] != start)
    long = elsewhere & (end - start >= window)
    where = (refs[c][first] for c in ("doc", "part", "pos"))
    factors = list(zip(*(c[long].tolist() for c in (start, end, *where))))
    return factors, places[shared]


def compared_windows(n: int, factors, blocks: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold a shared block and don't lie in a factor."""
    marks = np.zeros(n + 2, dtype=np.int64)
    low, high = np.maximum(blocks + BLOCK - window, 0), np.minimum(blocks, n - window) + 1
    some = high > low
    np.add.at(marks, low[some], 1)
    np.add.at(marks, high[some], -1)
    open_ = np.cumsum(marks)[: n - window + 1] > 0
    for start, end, *_ in factors:
        open_[start : end - window + 1] = False
    return np.flatnonzero(open_)


def factored(docs: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """One row for each document with shared blocks: doc, part, text; windows to compare: at, h1, h2; ends of duplicate
    stretches: in_doc, in_part, in_pos, sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out = []
                for doc, part, text, found in zip(*(some.column(i).to_pylist() if i != 3 else some.column(i) for i in range(4))):
                    table = found.values
                    names = ("pos", "link", "ref_doc", "ref_part", "ref_pos", "ref_link")
                    cols = {k: table.field(k).to_numpy() for k in names}
                    order = np.argsort(cols["pos"])
                    cols = {k: v[order] for k, v in cols.items()}
                    words, hashes = word_hashes(text)
                    stretches = Stretches(hashes)
                    places, _ = blocks_of(stretches, len(words), window)
                    links = links_of(stretches, places).view(np.int64)
                    index = np.searchsorted(places, cols["pos"])
                    refs = {"doc": cols["ref_doc"], "part": cols["ref_part"], "pos": cols["ref_pos"], "link": cols["ref_link"]}
                    factors, blocks = parse(places, links, (doc, part), index, refs, window)
                    starts = compared_windows(len(words), factors, blocks, window)
                    h1, h2 = (stretches.of(starts, starts + window, i).view(np.int64) for i in (0, 1))
                    ends = [(doc, part, p, s) for a, b, *_ in factors for p, s in ((a, 1), (b, -1))]
                    ends += [(d, k, q + x, s) for a, b, d, k, q in factors for x, s in ((0, 1), (b - a, -1))]
                    found_ends = [np.array(c, dtype=np.int64) for c in zip(*ends)] if ends else [np.empty(0, np.int64)] * 4
                    out.append((doc, part, text, starts, h1, h2, *found_ends))
                cols = list(zip(*out))
                types = [pa.int64(), pa.int64(), pa.string()] + [pa.list_(pa.int64())] * 7
                names = ["doc", "part", "text", "at", "h1", "h2", "in_doc", "in_part", "in_pos", "sum"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    rows = docs.select("doc", "part", "text").join(shared, ["doc", "part"]).select("doc", "part", "text", "found")
    lists = ", ".join(f"{c} array<bigint>" for c in ("at", "h1", "h2", "in_doc", "in_part", "in_pos", "sum"))
    return rows.mapInArrow(run, f"doc bigint, part bigint, text string, {lists}")


def _cut(rows: DataFrame) -> DataFrame:
    """doc, part, n_removed and kept (the words that stay, joined by a space) of rows with ends of duplicate stretches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                removed, kept = [], []
                for text, ends in zip(some.column(2).to_pylist(), some.column(3)):
                    words = text.encode("utf-8", "replace").split()
                    sums = np.zeros(len(words) + 1, dtype=np.int64)
                    sums[ends.values.field("pos").to_numpy()] = ends.values.field("sum").to_numpy()
                    stays = np.cumsum(sums)[: len(words)] <= 0
                    kept.append(b" ".join([w for w, k in zip(words, stays.tolist()) if k]).decode("utf-8", "replace"))
                    removed.append(len(words) - int(stays.sum()))
                cols = [some.column(0), some.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.record_batch(cols, names=["doc", "part", "n_removed", "kept"])

    return rows.mapInArrow(cut, "doc bigint, part bigint, n_removed bigint, kept string")


def deduplicated(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, part, n_removed, kept: a row for each document from which something is removed. See `_keyed` for doc and part."""
    keyed = _keyed(docs, id_col, text_col)
    blocks = written(block_rows(keyed, window), "blocks")
    # written, so that the join sees its size and splits the blocks' side where a block is frequent
    index = written(
        blocks.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "part", "pos", "link")).alias("ref"))
        .where("n > 1")
        .select(F.col("hash").alias("key"), "ref"),
        "block-index",
    )
    hits = blocks.join(index, F.col("hash") == F.col("key")).select(
        "doc",
        "part",
        "pos",
        "link",
        F.col("ref.doc").alias("ref_doc"),
        F.col("ref.part").alias("ref_part"),
        F.col("ref.pos").alias("ref_pos"),
        F.col("ref.link").alias("ref_link"),
    )
    # a document's own blocks: as many as its length allows, however many equal rows there are
    shared = hits.groupBy("doc", "part").agg(
        F.collect_set(F.struct("pos", "link", "ref_doc", "ref_part", "ref_pos", "ref_link")).alias("found")
    )
    shared = written(shared, "shared-blocks")
    discard(blocks, index)
    table = written(factored(keyed, shared, window), "factored")
    discard(shared)

    windows = table.select("doc", "part", F.explode(F.arrays_zip("at", "h1", "h2")).alias("w")).select("doc", "part", "w.at", "w.h1", "w.h2")
    twice = written(windows.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"), "repeated-windows")
    equal = written(windows.join(twice, ["h1", "h2"], "left_semi").select("doc", "part", "at"), "equal-windows")
    equal = equal.select(
        "doc", "part", F.explode(F.array(F.struct(F.col("at").alias("pos"), F.lit(1).cast("bigint").alias("sum")),
                                 F.struct((F.col("at") + window).alias("pos"), F.lit(-1).cast("bigint").alias("sum")))).alias("e")
    ).select("doc", "part", "e.pos", "e.sum")
    spans = table.select(F.explode(F.arrays_zip("in_doc", "in_part", "in_pos", "sum")).alias("e")).select(
        F.col("e.in_doc").alias("doc"), F.col("e.in_part").alias("part"), F.col("e.in_pos").alias("pos"), F.col("e.sum").alias("sum")
    )
    ends = spans.unionByName(equal).groupBy("doc", "part", "pos").agg(F.sum("sum").alias("sum")).where("sum != 0")
    ends = ends.groupBy("doc", "part").agg(F.collect_list(F.struct("pos", "sum")).alias("ends"))
    ends = written(ends, "stretches")
    return _cut(table.select("doc", "part", "text").join(ends, ["doc", "part"]).select("doc", "part", "text", "ends"))


def substring_digest(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    whole = F.regexp_replace(F.regexp_replace("text", f"^{SPACE}|{SPACE}$", ""), SPACE, " ")
    rows = _keyed(docs, id_col, text_col).select(
        "doc", "part", "doc_id", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"), F.sha2(whole, 256).alias("all")
    )
    cut = deduplicated(docs, window, id_col, text_col).select("doc", "part", "n_removed", F.sha2("kept", 256).alias("kept"))
    cut = written(cut, "cut")
    return rows.join(cut.dropDuplicates(["doc", "part"]), ["doc", "part"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("kept", "all").alias("kept_sha256")
    )
