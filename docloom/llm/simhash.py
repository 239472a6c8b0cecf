"""SimHash near-dedup with the generalised pigeonhole principle.

Two fingerprints within `bits` differing bits, cut into m partitions with thresholds that sum to bits - m + 1, differ in some
partition by at most its threshold (a partition with threshold -1 takes no part). Partitions are made of correlated bits,
so that the others select better; the thresholds come from a dynamic programme over the candidates that each would bring, as
estimated on a bounded sample of fingerprints. The plan decides the cost only: every pair within the distance is found.

Rows with one fingerprint are first reduced to their smallest id. Each distinct fingerprint is put in the buckets of its own
partition values and probes the buckets within the thresholds. With many fingerprints that is done in rounds of some
partitions each, so that no more than about `ROUND` rows for each fingerprint are on disk at a time. A bucket is compared
inside one task and gives a spanning forest of its verified links, not all pairs. Buckets above `bucket` members are split by
a further exact pigeonhole on the bits outside, if that saves more comparisons than it makes rows. What stays large, as a dense
group of copies does, is dealt into chunks, those at home and those that probe apart, and each pair of chunks with one at home
is compared by itself: the work spreads over tasks, and no task holds more than two chunks at a time. Components
are found by alternating star contraction, which moves links only.

`near_groups` can also compare wide fingerprints, of distinct shingles: probes then go by the first 64 bits, and a pair is a link if
the wide ones agree in as many bits as documents of the asked similarity do. `drop_near_copies` takes such pairs as
candidates only: each is verified on the shingle sets, and the prefix join of `setjoin` finds the links that they miss.

Defined results: null and empty texts have fingerprint zero and link like others; rows that repeat an id count as one
document; a null id never represents others; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import setjoin
from docloom.llm.common import discard, fresh, let_go, plain, written

SEED = 42
#: Seeds of the 64 bits each that make up a wide fingerprint.
WIDE_SEEDS = (1, 2, 3, 4)
WIDE = ("fp", "fp1", "fp2", "fp3")
BUCKET = 2048
#: Most rows of a chunk of a large bucket.
CELL = 1 << 14
SAMPLE = 4096
#: Rows in buckets for each fingerprint that a round holds, if one partition doesn't bring more; and rows that any round may hold.
ROUND = 12
ROWS = 1 << 22
#: Ends the bucket of a chunk at home and one of probes: those at home are compared with each other elsewhere.
ACROSS = "|"


def _majority(text: str | None, shingle: int, words: int, hashes_of) -> np.ndarray:
    """`words` numbers of 64 bits; bit i is set if it is set in over half of the shingles' hashes."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()  # on bytes: A-Z and the six ASCII spaces only
    if not tokens:
        return np.zeros(words, dtype="<u8")
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in tokens), dtype=np.int64, count=len(tokens))) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(tokens))
    n = len(tokens) - k + 1
    step = (1 << 16) // words
    ones = np.zeros(64 * words, dtype=np.int64)
    for at in range(0, n, step):
        last = min(n, at + step)
        spans = [line[a:b] for a, b in zip(starts[at:last].tolist(), ends[k - 1 + at : k - 1 + last].tolist())]
        bits = np.unpackbits(hashes_of(spans).reshape(len(spans), -1), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n, bitorder="little").view("<u8")


def _hashes(spans: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(x, SEED) for x in spans], dtype="<u8").view(np.uint8)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    return int(_majority(text, shingle, 1, _hashes)[0])


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """The numbers under one of a family of 64-bit hashes."""
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint_of_set(found: np.ndarray) -> np.ndarray:
    """256 bits as four numbers; bit i is set if it is set in over half of the hashes of a set's shingles."""
    ones, step = np.zeros(64 * len(WIDE), dtype=np.int64), 1 << 14
    for at in range(0, len(found), step):
        some = found[at : at + step]
        hashes = np.stack([_mix(some, seed) for seed in WIDE_SEEDS], axis=1).astype("<u8")
        ones += np.unpackbits(hashes.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(found), bitorder="little").view("<u8")


def wide_fingerprint(text: str | None, shingle: int = 5) -> np.ndarray:
    """256 bits as four numbers, of the distinct shingles."""
    return fingerprint_of_set(setjoin.shingle_set(text, shingle))


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, wide: bool = False
) -> DataFrame:
    """doc_id and fp, the fingerprint as a bigint of the same bits; a wide one goes on in fp1 to fp3."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    @F.pandas_udf(", ".join(f"{c} bigint" for c in WIDE))
    def wide_of(texts: pd.Series) -> pd.DataFrame:
        found = np.array([wide_fingerprint(t, shingle) for t in texts], dtype="<u8").reshape(-1, len(WIDE))
        return pd.DataFrame(found.view("<i8"), columns=list(WIDE))

    if wide:
        return docs.select(F.col(id_col).alias("doc_id"), wide_of(F.col(text_col)).alias("w")).select("doc_id", "w.*")
    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("fp"))


def wide_bits(similarity: float) -> int:
    """Differing bits of the wide fingerprints of two texts whose shingle sets, of one size, have the Jaccard similarity."""
    cosine = 2 * similarity / (1 + similarity)
    return int(math.acos(cosine) / math.pi * 64 * len(WIDE))


# ---------------------------------------------------------------- plan


@dataclass(frozen=True)
class Plan:
    parts: tuple[tuple[int, ...], ...]  # bits of each partition
    thresholds: tuple[int, ...]


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_groups(sample: np.ndarray, m: int) -> tuple[tuple[int, ...], ...]:
    """m partitions of near equal width; each grows from its first bit by the bits that go with it most."""
    bits = _bits(sample).astype(np.float64)
    bits -= bits.mean(axis=0)
    norm = np.sqrt((bits**2).sum(axis=0))
    related = np.abs(bits.T @ bits) / np.maximum(np.outer(norm, norm), 1e-9)
    free, groups = list(range(64)), []
    for i in range(m):
        width = len(free) // (m - i)
        group = [free.pop(0)]
        while len(group) < width:
            group.append(free.pop(int(np.argmax(related[np.ix_(free, group)].sum(axis=1)))))
        groups.append(tuple(sorted(group)))
    return tuple(groups)


def _ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1))


def allocate(cost: list[list[float]], bits: int) -> tuple[float, tuple[int, ...]]:
    """Cheapest thresholds with sum bits - m + 1; cost[i][t + 1] is what threshold t of partition i costs."""
    goal = bits + 1  # of thresholds plus one each
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for row in cost:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (c, chosen) in best.items():
            for t, more in enumerate(row):
                if used + t <= goal and (used + t not in step or c + more < step[used + t][0]):
                    step[used + t] = (c + more, (*chosen, t - 1))
        best = step
    return best[goal]


def make_plan(sample: np.ndarray, n: int, bits: int) -> Plan:
    """The cheapest plan for n fingerprints: rows to shuffle, at `shuffled` comparisons each as measured, and comparisons."""
    shuffled = 1500.0
    choices = []
    other = np.random.default_rng(SEED).permutation(len(sample))
    a, b = np.repeat(sample, 64), np.concatenate([sample[np.roll(other, r)] for r in range(64)])
    apart = a != b
    xor = (a ^ b)[apart]
    for m in range(max(1, bits // 2), bits + 2):
        parts = correlated_groups(sample, m) if len(sample) > 1 else correlated_groups(np.arange(2, dtype=np.uint64), m)
        cost = []
        for part in parts:
            mask = np.uint64(sum(1 << i for i in part))
            near = np.bincount(np.bitwise_count(xor & mask), minlength=len(part) + 1)[: bits + 1].cumsum()
            row = [0.0]
            for t in range(min(2, bits) + 1):
                # at least what independent even bits would bring
                share = max(near[t] / max(1, len(xor)), _ball(len(part), t) / 2.0 ** len(part))
                row.append(n * shuffled * _ball(len(part), t) + n * n * share / 2)
            cost.append(row)
        choices.append((*allocate(cost, bits), parts))
    _, thresholds, parts = min(choices, key=lambda c: c[0])
    return Plan(parts, thresholds)


def _gather(fps: np.ndarray, part: tuple[int, ...]) -> np.ndarray:
    """The part's bits as a number."""
    out = np.zeros(len(fps), dtype=np.uint64)
    for i, bit in enumerate(part):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(i)
    return out


def _flips(width: int, radius: int) -> list[int]:
    """All values of `width` bits with at most `radius` of them set."""
    out = [0]
    for _ in range(radius):
        out = sorted({v | (1 << i) for v in out for i in range(width)} | set(out))
    return out


# ---------------------------------------------------------------- buckets


def _rounds(plan: Plan, n: int) -> list[list[int]]:
    """The partitions that take part, dealt into rounds of about ROUND rows for each of n fingerprints."""
    out, held, most = [], 0, max(ROUND, ROWS // max(n, 1))
    for i, (part, t) in enumerate(zip(plan.parts, plan.thresholds)):
        if t >= 0:
            rows = _ball(len(part), t)
            if not out or held + rows > most:
                out.append([])
                held = 0
            out[-1].append(i)
            held += rows
    return out


def _buckets(nodes: DataFrame, plan: Plan, chosen: list[int]) -> DataFrame:
    """(bucket, node, fp.., home, free) of the chosen partitions: homes in the bucket of their own value, and probes. free: the
    bits outside."""
    columns = [c for c in WIDE if c in nodes.columns]
    fixed = []
    for i in chosen:
        part, t = plan.parts[i], plan.thresholds[i]
        mask = sum(1 << b for b in part)
        fixed.append((i, part, _flips(len(part), t), np.int64(np.uint64(~mask & (2**64 - 1)).view(np.int64))))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps, node = batch["fp"].to_numpy().view(np.uint64), batch["node"].to_numpy()
            for i, part, flips, free in fixed:
                value = _gather(fps, part)
                for flip in flips:
                    key = [f"{i}.{v}" for v in (value ^ np.uint64(flip)).tolist()]
                    held = {c: batch[c].to_numpy() for c in columns}
                    yield pd.DataFrame({"bucket": key, "node": node, **held, "home": flip == 0, "free": free})
        let_go()

    kinds = "".join(f"{c} bigint, " for c in columns)
    return nodes.select("node", *columns).mapInPandas(put, f"bucket string, node bigint, {kinds}home boolean, free bigint")


def _split(rows: DataFrame, bits: int) -> DataFrame:
    """The rows of large buckets in the buckets of a further exact pigeonhole on their free bits."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for free, group in batch.groupby("free"):
                left = [i for i in range(64) if (int(free) >> i) & 1]
                fps = group["fp"].to_numpy().view(np.uint64)
                for j in range(bits + 1):
                    part = tuple(left[j :: bits + 1])
                    mask = sum(1 << b for b in part)
                    key = [f"{b}/{j}.{v}" for b, v in zip(group["bucket"], _gather(fps, part).tolist())]
                    rest = (int(free) & (2**64 - 1)) & ~mask
                    yield group.assign(bucket=key, free=np.int64(np.uint64(rest).view(np.int64)))

    return rows.mapInPandas(put, rows.schema)


def _near(x: np.ndarray, y: np.ndarray, bits: int, most: int) -> np.ndarray:
    """Whether fingerprints, one column for each 64 bits, link: by the first column, and by all if there are more."""
    near = np.bitwise_count(x[..., 0] ^ y[..., 0]) <= bits
    if x.shape[-1] > 1:
        at = np.nonzero(near)
        apart = np.bitwise_count(np.broadcast_to(x, (*near.shape, x.shape[-1]))[at] ^ np.broadcast_to(y, (*near.shape, y.shape[-1]))[at])
        near[at] = apart.sum(axis=-1, dtype=np.int64) <= most
    return near


def _forest(fps: np.ndarray, home: np.ndarray, bits: int, most: int, across: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions a, b) of a spanning forest of the linked pairs of which one, or if `across` just one, is at home."""
    n = len(fps)
    order = np.argsort(~home, kind="stable")  # those at home come first, and are compared with what follows them
    fps = fps[order]
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out_a, out_b = [], []
    homes = int(home.sum())
    step = max(1, (1 << 20) // n)
    for at in range(0, homes, step):
        first = homes if across else at
        i, j = np.nonzero(_near(fps[at : min(homes, at + step), None], fps[None, first:], bits, most))
        i, j = at + i, first + j
        real = i < j
        for a, b in zip(i[real].tolist(), j[real].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[rb] = ra
                out_a.append(a)
                out_b.append(b)
    return order[np.array(out_a, dtype=np.int64)], order[np.array(out_b, dtype=np.int64)]


def _verify(rows: DataFrame, bits: int, most: int) -> DataFrame:
    """Links (a, b) inside buckets. Rows are dealt by bucket and sorted, so each bucket is a run within a task."""
    columns = [c for c in WIDE if c in rows.columns]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held: list[pd.DataFrame] = []

        def links(run: pd.DataFrame) -> pa.RecordBatch:
            key = run["bucket"].to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(run)]])
            fps, node, home = run[columns].to_numpy().view(np.uint64), run["node"].to_numpy(), run["home"].to_numpy()
            small, big = [], []
            sizes = np.diff(edges)
            # pairs at distance d in the sorted order lie in one bucket if d is less than its size
            for s, e in zip(edges[:-1][sizes > 32].tolist(), edges[1:][sizes > 32].tolist()):
                a, b = _forest(fps[s:e], home[s:e], bits, most, key[s].endswith(ACROSS))
                big.append(np.stack([node[s:e][a], node[s:e][b]]))
            size_of = np.repeat(np.where(sizes > 32, 0, sizes), sizes)
            last = np.repeat(edges[1:], sizes)
            place = np.arange(len(run))
            for d in range(1, int(size_of.max(initial=0))):
                i = place[(size_of > d) & (place + d < last)]
                near = _near(fps[i], fps[i + d], bits, most) & (home[i] | home[i + d])
                small.append(np.stack([node[i[near]], node[i[near] + d]]))
            both = np.concatenate([np.empty((2, 0), dtype=np.int64), *small, *big], axis=1)
            return pa.record_batch([pa.array(both.min(axis=0)), pa.array(both.max(axis=0))], schema=schema)

        for batch in batches:
            frame = batch.to_pandas()
            if not len(frame):
                continue
            key = frame["bucket"].to_numpy()
            cut = len(key) - int(np.argmax(key[::-1] != key[-1])) if (key != key[-1]).any() else 0
            if cut:
                yield links(pd.concat([*held, frame.iloc[:cut]], ignore_index=True))
                held = [frame.iloc[cut:]]
            else:
                if held and held[-1]["bucket"].iloc[-1] != key[-1]:
                    yield links(pd.concat(held, ignore_index=True))
                    held = []
                held.append(frame)
        if held:
            yield links(pd.concat(held, ignore_index=True))
        let_go()

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(compare, "a bigint, b bigint").where("a != b").distinct()


def links(nodes: DataFrame, bits: int = 4, bucket: int = BUCKET, sample_size: int = SAMPLE, most: int = 0, spent: list | None = None) -> DataFrame:
    """(a, b): links between the distinct fingerprints of `nodes` (node, fp, or all of a wide one's columns) that leave their
    components whole. `most`: differing bits of wide fingerprints. `spent` gets the tables to discard once the links are written."""
    n = nodes.count()
    spot = F.pmod(F.xxhash64("fp"), F.lit(1 << 20))
    sample = nodes.where(spot < max(1, (1 << 20) * sample_size // max(n, 1))).select("fp").limit(2 * sample_size).collect()
    plan = make_plan(np.array([r[0] for r in sample], dtype=np.int64).view(np.uint64), n, bits)

    # a further pigeonhole makes bits + 1 rows of each, and buckets that are smaller by the values of some free bits
    deeper = 1 << (64 - max(map(len, plan.parts))) // (bits + 1) > (bits + 1) ** 2
    found = []
    for chosen in _rounds(plan, n):
        held = [written(_buckets(nodes, plan, chosen), "buckets")]
        found.append(written(_round(held, bits, bucket, most, deeper), "round"))
        discard(*held)
    if spent is not None:
        spent.extend(found)
    return reduce(DataFrame.unionByName, found).distinct()


def _round(held: list[DataFrame], bits: int, bucket: int, most: int, deeper: bool) -> DataFrame:
    """Links (a, b) inside the buckets of a round, which are split if they are large. `held`: the buckets' rows, gets what else
    is written."""
    (rows,) = held
    held.append(large := _large(rows, bucket))
    if large.isEmpty():
        return _verify(rows, bits, most)
    small = rows.join(large.select("bucket"), "bucket", "left_anti")
    if deeper:
        held.append(rows := written(_split(rows.join(large, "bucket", "left_semi"), bits), "buckets"))
        held.append(large := _large(rows, bucket))
        rest = rows.join(large.select("bucket"), "bucket", "left_anti")
        small = small.unionByName(rest)
    return _verify(small.unionByName(_cells(rows, large, min(8 * bucket, CELL))), bits, most)


def _large(rows: DataFrame, bucket: int) -> DataFrame:
    """(bucket, homes, probes): the buckets above `bucket` members with their numbers of both kinds."""
    homes = F.count(F.when(F.col("home"), 1))
    counted = rows.groupBy("bucket").agg(homes.alias("homes"), (F.count(F.lit(1)) - homes).alias("probes"))
    return written(counted.where(F.col("homes") + F.col("probes") > bucket), "large")


def _cells(rows: DataFrame, large: DataFrame, chunk: int) -> DataFrame:
    """The rows of large buckets, dealt into chunks by a hash, in a bucket for each pair of chunks at home, and for each of one
    at home and one of probes."""
    homes, probes = F.ceil(F.col("homes") / F.lit(chunk)), F.ceil(F.col("probes") / F.lit(chunk))
    dealt = rows.join(large, "bucket").withColumns({"homes": homes, "probes": probes})
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("probes"))))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    name = lambda *of: F.concat_ws(".", F.concat("bucket", F.lit("#")), *of)
    among = F.transform(upto("homes"), lambda x: name(F.least("own", x), F.greatest("own", x)))
    to_probes = F.transform(upto("probes"), lambda x: F.concat(name(F.col("own"), x), F.lit(ACROSS)))
    to_homes = F.transform(upto("homes"), lambda x: F.concat(name(x, F.col("own")), F.lit(ACROSS)))
    to_probes = F.when(F.col("probes") > 0, to_probes).otherwise(F.array().cast("array<string>"))
    cells = F.when(F.col("home"), F.concat(among, to_probes)).otherwise(F.when(F.col("homes") > 0, to_homes))
    return dealt.withColumn("bucket", F.explode(cells)).select(rows.columns)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for all nodes that have a link, by alternating star contraction.

    A node's neighbours are aggregated, never gathered; the node with most links costs a skewed join, which Spark splits.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "stars")
    before = None
    while True:
        # large star: the larger neighbours of a node move to its smallest neighbour
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "stars")
        # small star: the smaller neighbours of a node, and itself, move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u != v").distinct(), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_groups(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = 4,
    bucket: int = BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float | None = None,
) -> DataFrame:
    """doc_id, fp, component_id of every row. With a `similarity`, links are verified on wide fingerprints."""
    wide = similarity is not None
    rows = written(fingerprints(docs, id_col, text_col, shingle, wide), "fingerprints")
    columns = [c for c in WIDE if c in rows.columns]
    nodes = written(rows.groupBy(*columns).agg(F.min("doc_id").alias("node")), "nodes")
    most = wide_bits(similarity) if wide else 0
    roots = components(links(nodes.where("node is not null"), bits, bucket, most=most))
    classes = nodes.join(roots, "node", "left").select(
        *(F.col(c).alias(f"class_{c}") for c in columns), F.coalesce("root", "node").alias("component_id")
    )
    same = [F.col(c) == F.col(f"class_{c}") for c in columns]
    return rows.join(classes, same, "left").select("doc_id", "fp", "component_id")


def near_digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hex and component_id of every row."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_groups(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


def set_rows(texts: DataFrame, shingle: int, t: Fraction, rare_first: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, text_hash, node (a hash of the shingle set), its size, signature, long signature if it needs one, wide
    fingerprint and prefix."""
    shared = texts.sparkSession.sparkContext.broadcast(rare_first)
    names = ["doc_id", "text_hash", "node", "size", "signature", "parities", *WIDE, "prefix"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [setjoin.shingle_set(x, shingle) for x in batch.column(2).to_pylist()]
                node = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], dtype="<u8").view("<i8")
                wide = np.array([fingerprint_of_set(s) for s in sets], dtype="<u8").reshape(-1, len(WIDE)).view("<i8")
                first = [setjoin.prefix(s, t, shared.value).tobytes() for s in sets]
                size = pa.array([len(s) for s in sets], pa.int32())
                bits = pa.array([setjoin.signature(s) for s in sets], pa.binary())
                more = pa.array([setjoin.long_signature(s) for s in sets], pa.binary())
                cols = [batch.column(0), batch.column(1), pa.array(node), size, bits, more]
                cols += [*(pa.array(wide[:, i].copy()) for i in range(len(WIDE))), pa.array(first, pa.binary())]
                yield pa.record_batch(cols, names=names)
        let_go()

    kind = texts.schema["doc_id"].dataType.simpleString()
    fps = ", ".join(f"{c} bigint" for c in WIDE)
    schema = f"doc_id {kind}, text_hash bigint, node bigint, size int, signature binary, parities binary, {fps}, prefix binary"
    return texts.select("doc_id", "text_hash", "text").mapInArrow(read, schema)


def near_sets(texts: DataFrame, shingle: int, similarity: float, bits: int, bucket: int) -> DataFrame:
    """doc_id, text_hash, component of each of `texts` (doc_id, text_hash, text): the components of the links between distinct
    shingle sets of the Jaccard similarity. SimHash finds most links, the prefix join all that connect something else."""
    t = setjoin.fraction(similarity)
    rows = written(set_rows(texts, shingle, t, setjoin.frequent_shingles(texts, shingle)), "shingle-sets")
    firsts = (F.first(c).alias(c) for c in ("size", "signature", "parities", *WIDE, "prefix"))
    nodes = rows.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), *firsts)
    nodes = written(nodes.select("node", "rep.doc_id", "rep.text_hash", "size", "signature", "parities", *WIDE, "prefix"), "nodes")
    node_of = written(rows.select("doc_id", "text_hash", "node"), "node-of-row")
    discard(rows)
    reps = nodes.select("node", "doc_id", "text_hash", "size", F.coalesce("parities", "signature").alias("signature"))
    spent: list[DataFrame] = []
    pairs = written(links(nodes.select("node", *WIDE), bits, bucket, most=wide_bits(similarity), spent=spent), "candidates")
    discard(*spent)
    found = setjoin.verified(pairs, reps, texts, shingle, t)
    keys = written(setjoin.bucket_rows(nodes, t), "prefixes")
    for all_pairs in (False, True):
        roots = components(found)
        every, keys = keys, setjoin.open_rows(keys, roots)
        discard(every)
        pairs = written(setjoin.candidates(keys, nodes.select("node", "signature"), roots, t, all_pairs), "candidates")
        found = found.unionAll(setjoin.verified(pairs, reps, texts, shingle, t))
    discard(keys, nodes)
    roots = components(found)
    return node_of.join(roots, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("component"))


def drop_near_copies(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    bits: int = 10,
    bucket: int = 8 * BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` without near copies, with their columns: of each component of texts whose sets of distinct shingles
    have the Jaccard similarity, one row with the smallest id stays, whatever becomes of other rows with that id. Rows with a
    null id are judged among themselves, by the same rule with a hash of the text as id; they never give way to others."""
    key, state = fresh(docs, "text_hash", "state")
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    keyed = known.withColumn(key, F.xxhash64(plain(F.col(f"`{text_col}`"))))
    texts = keyed.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(key).alias("text_hash"), F.col(f"`{text_col}`").alias("text"))
    rows = near_sets(texts, shingle, similarity, bits, bucket)
    rows = written(rows.groupBy("doc_id", "text_hash", "component").agg(F.count(F.lit(1)).alias("n")), "near-copies")
    best = rows.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"))
    stays = F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.text_hash") == F.col("text_hash"))
    marks = rows.join(best, "component").select("doc_id", "text_hash", F.when(stays, 1).otherwise(0).alias(state), "n")
    marks = written(marks.where((F.col(state) == 0) | (F.col("n") > 1)).drop("n"), "marks")
    same = (keyed[f"`{id_col}`"] == marks["doc_id"]) & (keyed[key] == marks["text_hash"])
    out = keyed.join(marks, same, "left_anti").drop(key)
    repeated = marks.where(F.col(state) == 1)
    if not repeated.isEmpty():
        same = (keyed[f"`{id_col}`"] == repeated["doc_id"]) & (keyed[key] == repeated["text_hash"])
        out = out.unionAll(keyed.join(repeated, same, "left_semi").dropDuplicates([id_col, key]).drop(key))
    nameless = docs.where(F.col(f"`{id_col}`").isNull())
    if nameless.isEmpty():
        return out
    (own,) = fresh(docs, "own_id")
    named = nameless.withColumn(own, F.xxhash64(plain(F.col(f"`{text_col}`"))))
    return out.unionAll(drop_near_copies(named, shingle, similarity, bits, bucket, own, text_col).drop(own))
