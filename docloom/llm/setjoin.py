"""Exact join of shingle sets by Jaccard similarity, with prefix filtering.

The shingles of a set are put in one global order, those that are frequent in a sample last. Two sets of similarity t or more
have their first common shingle within the first n - ceil(2t / (1 + t) * n) + 1 shingles of the smaller one and the first
n - ceil(t * n) + 1 of the other. So each set goes to the buckets of its first shingles, a pair inside a bucket is a candidate
if the shingles from there on can suffice and the signatures allow it. The order decides the cost only: the sample behind it
grows with the texts, so that what is not known as frequent has few texts however many there are. Signatures go with the rows
of buckets that have several components only. They can't tell large sets apart, so candidates are checked once more by
signatures that are as long as the sets need. What is left is verified on the whole sets, in slices whose sets take a bounded
share of disk however many pairs there are.

Links are wanted up to connectedness, so pairs inside one component are never verified. Neighbours in each bucket are compared
first; once they have joined a dense group of copies, only what lies outside its largest component is compared with
all of its bucket. Large buckets are dealt into pairs of chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import discard, let_go, written
from docloom.operators import restrict

#: Most members of a chunk of a large bucket.
CHUNK = 1 << 14
#: Members at these distances in a bucket are compared before all others.
NEIGHBOURS = 4
#: Least number of texts sampled for the order of shingles, least share of them, and most shingles that are put last.
SAMPLE = 1 << 14
SHARE = 1 / 16
FREQUENT = 1 << 22
#: Bits of a signature.
SIGNATURE = 1024
#: Pairs whose signatures are compared at a time.
PAIRS = 1 << 14
#: Pairs that a task gathers before it gives them without repeats.
HELD = 1 << 18
#: Shingles hashed at a time.
STEP = 1 << 14
#: Least number of shingles, of all pairs of a slice, that are moved at a time; else it is an eighth of those of all nodes.
SLICE = 1 << 23


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a text shorter than a shingle is one."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()  # on bytes: A-Z and the six ASCII spaces only
    if not tokens:
        return np.zeros(0, dtype="<u8")
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in tokens), dtype=np.int64, count=len(tokens))) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(tokens))
    n = len(tokens) - k + 1
    digest, found = xxhash.xxh3_64_intdigest, []
    for at in range(0, n, STEP):
        last = min(n, at + STEP)
        spans = zip(starts[at:last].tolist(), ends[k - 1 + at : k - 1 + last].tolist())
        found.append(np.array([digest(line[a:b]) for a, b in spans], dtype="<u8"))
    return np.unique(np.concatenate(found))


def fraction(similarity: float) -> Fraction:
    return Fraction(str(similarity))


def prefix(found: np.ndarray, t: Fraction, rare_first: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set in the global order. `rare_first`: sorted frequent shingles and the rank of each."""
    n = len(found)
    if not n:
        return found
    frequent, rank = rare_first
    length = n - math.ceil(t * n) + 1
    if not len(frequent):
        return found[:length]
    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
    place = np.where(frequent[at] == found, rank[at] + 1, 0)
    return found[np.argsort(place, kind="stable")[:length]]


def frequent_shingles(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a bounded sample of the texts, sorted, and their ranks from the rarest on."""
    n = max(texts.count(), 1)
    spot = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 30))
    some = texts.where(spot < int((1 << 30) * max(SAMPLE / n, SHARE))).select("text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                found = [shingle_set(x, shingle) for x in whole.column(0).slice(at, 256).to_pylist()]
                yield pa.record_batch([pa.array(np.concatenate(found).view("<i8"))], names=["key"])
        let_go()

    counted = some.mapInArrow(hashed, "key bigint").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    counted = written(counted, "frequent")
    least, total = 3, 0
    for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("keys")).orderBy(F.desc("n")).collect():
        total += r["keys"]
        if total > FREQUENT:
            least = r["n"] + 1
            break
    found = counted.where(F.col("n") >= least).toArrow()  # a bounded number
    discard(counted)
    keys, times = found.column("key").to_numpy().view("<u8"), found.column("n").to_numpy()
    rank = np.empty(len(keys), dtype=np.int64)
    rank[np.lexsort((keys, times))] = np.arange(len(keys))
    order = np.argsort(keys)
    return keys[order], rank[order]


def is_near(x: np.ndarray, y: np.ndarray, t: Fraction) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common * t.denominator >= t.numerator * (len(x) + len(y) - common)


def signature(found: np.ndarray) -> bytes:
    """Parities of the numbers of shingles in SIGNATURE classes: two sets differ in at least as many shingles as bits."""
    n = np.bincount((found & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE)
    return np.packbits(n & 1).tobytes()


def long_signature(found: np.ndarray) -> bytes | None:
    """The like in as many classes as the set has shingles, or up to twice as many; none if SIGNATURE are enough."""
    if len(found) <= SIGNATURE:
        return None
    classes = 1 << (len(found) - 1).bit_length()
    n = np.bincount((found & np.uint64(classes - 1)).astype(np.int64), minlength=classes)
    return np.packbits(n & 1).tobytes()


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """Differing bits of two signatures, the longer one folded: both count shingles by the last bits of their hashes."""
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def may_be_near(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, t: Fraction) -> np.ndarray:
    """Whether signatures, a row of numbers each, leave it open that two sets, of so many shingles in all, are near."""
    p, q = t.denominator - t.numerator, t.numerator + t.denominator
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) * q <= p * sizes


def possible(pairs: DataFrame, nodes: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (a, b) that the signatures of `nodes` (node, size, signature) don't rule out for certain."""

    p, q = t.denominator - t.numerator, t.numerator + t.denominator

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v.as_buffer(), "<u8") for v in batch.column(c)] for c in (2, 3))
            allowed = [apart(*two) * q <= p * n for *two, n in zip(x, y, batch.column(4).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(allowed, pa.bool_()))

    x, y = (nodes.select(F.col("node").alias(n), F.col("signature").alias(f"{n}_bits"), F.col("size").cast("bigint").alias(f"{n}_size")) for n in "ab")
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "a_bits", "b_bits", F.col("a_size") + F.col("b_size"))
    return both.mapInArrow(check, "a bigint, b bigint")


def bucket_rows(nodes: DataFrame, t: Fraction) -> DataFrame:
    """(bucket, node, size, place, home) of nodes (node, size, prefix). home: within the prefix of the smaller set."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                node, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                keys = [np.frombuffer(x, dtype="<i8") for x in batch.column(2).to_pylist()]
                length = np.array([len(k) for k in keys], dtype=np.int64)
                if not length.sum():
                    continue
                place = np.concatenate([np.arange(n, dtype=np.int32) for n in length.tolist()])
                # size - ceil(2t / (1 + t) * size) is the last place, in whole numbers
                p, q = 2 * t.numerator, t.numerator + t.denominator
                last = np.repeat(size - -(-size.astype(np.int64) * p // q), length)
                cols = [np.concatenate(keys), np.repeat(node, length), np.repeat(size, length), place, place <= last]
                yield pa.record_batch([pa.array(c) for c in cols], names=["bucket", "node", "size", "place", "home"])
        let_go()

    return nodes.select("node", "size", "prefix").mapInArrow(put, "bucket bigint, node bigint, size int, place int, home boolean")


def _candidates(rows: DataFrame, t: Fraction, all_pairs: bool) -> DataFrame:
    """(a, b) of nodes in one bucket that can be near and lie in different components: neighbours, or all. Pairs that meet in
    many buckets of a task are given once."""
    p, q = t.numerator, t.numerator + t.denominator

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(both: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        held, n = [], 0
        for both in found(batches):
            held.append(both)
            n += both.shape[1]
            if n >= HELD:
                held = [np.unique(np.concatenate(held, axis=1), axis=1)]
                if held[0].shape[1] >= HELD // 2:
                    yield given(held.pop())
                n = sum(x.shape[1] for x in held)
        if held:
            yield given(np.unique(np.concatenate(held, axis=1), axis=1))
        let_go()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        def pairs(held: list[pa.RecordBatch]) -> Iterator[np.ndarray]:
            run = pa.Table.from_batches(held)
            key = [run.column(c).to_numpy() for c in ("bucket", "cell")]
            node, root, size, place, home = (run.column(c).to_numpy() for c in ("node", "root", "size", "place", "home"))
            size, place = size.astype(np.int64), place.astype(np.int64)
            bits = np.frombuffer(b"".join(run.column("signature").to_pylist()), "<u8").reshape(len(node), -1)
            edges = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
            edges = np.concatenate([[0], edges, [len(node)]])

            def out(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                smaller = np.where((size[i] < size[j]) | ((size[i] == size[j]) & home[i]), home[i], home[j])
                needed = -(-(size[i] + size[j]) * p // q)
                ok = (root[i] != root[j]) & smaller & (np.minimum(size[i] - place[i], size[j] - place[j]) >= needed)
                i, j = i[ok], j[ok]
                allowed = [
                    may_be_near(bits[some], bits[others], size[some] + size[others], t)
                    for some, others in ((i[at : at + PAIRS], j[at : at + PAIRS]) for at in range(0, len(i), PAIRS))
                ]
                ok = np.concatenate(allowed) if allowed else np.zeros(0, dtype=bool)
                a, b = node[i[ok]], node[j[ok]]
                return np.stack([np.minimum(a, b), np.maximum(a, b)])

            sizes = np.diff(edges)
            last, spot = np.repeat(edges[1:], sizes), np.arange(len(node))
            for d in range(1, min(NEIGHBOURS, int(sizes.max()) - 1) + 1):
                i = spot[spot + d < last]
                yield out(i, i + d)
            if not all_pairs:
                return
            for s, e in zip(edges[:-1][sizes > NEIGHBOURS + 1].tolist(), edges[1:][sizes > NEIGHBOURS + 1].tolist()):
                names, inverse, n = np.unique(root[s:e], return_inverse=True, return_counts=True)
                if len(names) == 1:
                    continue
                others = s + np.flatnonzero(inverse != n.argmax())
                others_place = np.full(e - s, e - s)
                others_place[others - s] = np.arange(len(others))
                step = max(1, (1 << 20) // (e - s))
                for at in range(0, len(others), step):
                    some = others[at : at + step]
                    # each pair of others once, and others with all of the largest component
                    i, j = np.nonzero(others_place[None, :] > (at + np.arange(len(some)))[:, None])
                    yield out(some[i], s + j)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            cell = batch.column(6).to_numpy()
            other = (key != key[-1]) | (cell != cell[-1])
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if cut:
                yield from pairs([*held, batch.slice(0, cut)])
                held = [batch.slice(cut)]
            elif held and (held[-1].column(0)[-1].as_py(), held[-1].column(6)[-1].as_py()) != (key[-1], cell[-1]):
                yield from pairs(held)
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield from pairs(held)

    dealt = rows.select("bucket", "node", "root", "size", "place", "home", "cell", "signature")
    dealt = dealt.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", "node")
    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows with their component so far, by `roots` (node, root)."""
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def open_rows(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of `bucket_rows` in buckets of several components, written: no other bucket can give a link. What is left out
    stays out, as components only grow."""
    ends = rooted(rows, roots).groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    buckets = written(ends.where("low != high").select("bucket"), "open")
    kept = written(rows.join(buckets, "bucket", "left_semi"), "prefixes")
    discard(buckets)
    return kept


def candidates(rows: DataFrame, nodes: DataFrame, roots: DataFrame, t: Fraction, all_pairs: bool, chunk: int = CHUNK) -> DataFrame:
    """(a, b): pairs to verify. `rows` are of `open_rows`, `nodes` has the signatures (node, signature), `roots` the components
    so far (node, root)."""
    rows = rooted(rows, roots).withColumn("cell", F.lit(0).cast("bigint")).join(nodes, "node")
    if not all_pairs:
        return _candidates(rows, t, False)
    counted = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    large = written(counted.where((F.col("n") > chunk) & (F.col("low") != F.col("high"))).select("bucket", "n"), "large")
    if large.isEmpty():
        return _candidates(rows, t, True)
    alike = counted.where(F.col("n") > chunk).select("bucket")
    chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("bigint")
    dealt = rows.join(large, "bucket").withColumns({"chunks": chunks, "own": F.pmod(F.xxhash64("node"), chunks)})
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    dealt = dealt.withColumn("cell", F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).select(rows.columns)
    return _candidates(rows.join(alike, "bucket", "left_anti").unionByName(dealt), t, True)


def verified(found: DataFrame, reps: DataFrame, texts: DataFrame, shingle: int, t: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity, written. `reps`: a row for each node (node, doc_id, text_hash, size,
    signature); `texts`: doc_id, text_hash, text. The sets of a slice of the pairs are joined with them at a time."""
    pairs = written(possible(found, reps, t), "pairs")
    chosen = written(_chosen(pairs, reps), "chosen")
    sizes = chosen.select("node", "size")
    both = pairs.join(sizes.toDF("a", "a_size"), "a").join(sizes.toDF("b", "b_size"), "b")
    moved = both.agg(F.sum(F.col("a_size") + F.col("b_size").cast("bigint"))).first()[0] or 0
    held = chosen.agg(F.sum("size")).first()[0] or 0
    most = max(SLICE, (reps.agg(F.sum("size")).first()[0] or 0) // 8)
    n = max(1, -(-moved // most))
    sets = written(_sets(chosen, texts, shingle), "sets") if held <= most else None
    out = []
    for i in range(n):
        some = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(n)) == i) if n > 1 else pairs
        own = sets or written(_sets(_chosen(some, chosen), texts, shingle), "sets")
        out.append(written(_near(some, own, t), "links"))
        if own is not sets:
            discard(own)
    discard(pairs, chosen, *([] if sets is None else [sets]))
    if n == 1:
        return out[0]
    near = written(reduce(DataFrame.unionAll, out), "links")
    discard(*out)
    return near


def _chosen(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Nodes of the pairs: node, doc_id, text_hash, size."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return reps.join(nodes, "node", "left_semi").select("node", "doc_id", "text_hash", "size")


def _sets(chosen: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(node, found): the shingle sets of the chosen nodes. Texts that no hash bit asks for are dropped where they are read."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [shingle_set(x, shingle).tobytes() for x in batch.column(1).to_pylist()]
                yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["node", "found"])
        let_go()

    key = F.xxhash64("doc_id", "text_hash").alias("_key")
    asked = restrict.possible(texts.select("*", key), "_key", restrict.bit_words(chosen.select(key), "_key"))
    whole = asked.join(chosen, ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"])
    return whole.mapInArrow(hashed, "node bigint, found binary")


def _near(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            near = [is_near(np.frombuffer(p.as_buffer(), "<u8"), np.frombuffer(q.as_buffer(), "<u8"), t) for p, q in zip(x, y)]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))
        let_go()

    x, y = (sets.select(F.col("node").alias(n), F.col("found").alias(f)) for n, f in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")
