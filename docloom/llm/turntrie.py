"""Prefix trie of conversations from padded matrices of turn ids.

A turn's id is the MD5 digest of its role and text; a node is named by its depth and a 128-bit hash of the ids that lead to
it. Conversations are cut into blocks of `WIDTH` turns, so that one of any length is many rows, and blocks are
range-partitioned in the order of what precedes them and their ids. Each shard holds its blocks as rows of a padded matrix,
sorts them with numpy's lexsort, marks where a column or one before it changes (the marks are carried from column to
column), and aggregates each depth's nodes between the marks with reduceat. Nodes that hold a shard's first or last row may go
on in another shard; they alone are summed again by Spark. Equal conversations are told apart by their id, so a group of any
size is dealt over shards.

Sums over subtrees are sums over members: a conversation owns the nodes whose smallest member it is, which are the deepest of
its path. A second pass over the shards sums what members own; of the nodes that a node's own smallest member owns, those
above it are taken off.

The order of turns is found without a task for a conversation: rows are range-partitioned and numbered, and a conversation
that several partitions share gets offsets, one row for a partition at most.

Defined results: null roles and texts are empty; turns that tie are ordered by their id's digest, and equal rows are turns of
their own; rows without conv_id belong to no conversation and are left out; an empty table has no nodes; other columns don't
matter, whatever their names. A node's list of conversations that end there is hashed in one task, as SHA-256 asks, from
pieces that its shards made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import discard, shuffle_partitions, written

#: Turns of a block.
WIDTH = 32
#: Turns of a shard, roughly.
SHARD = 1 << 19
#: Nodes of a conversation that are summed up in one window.
STRETCH = 1 << 12
#: Odd multipliers of two polynomial hashes modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MASK = (1 << 64) - 1

NODE = ["depth", "h1", "h2"]


# ---------------------------------------------------------------- order of turns


def ordered(convs: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(c, pos, key, n), written: the turns of each conversation in order, their ids, their texts' code points."""
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in (role_col, text_col))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = convs.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("c"), F.col(turn_col).alias("t"), key.alias("key"), F.char_length(text).cast("bigint").alias("n")
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.column(0).to_numpy()
            start = np.concatenate([[0], np.flatnonzero(c[1:] != c[:-1]) + 1])
            at = np.arange(len(c)) - np.repeat(start, np.diff(np.concatenate([start, [len(c)]])))
            if c[0] == last:
                at[: start[1] if len(start) > 1 else len(c)] += before
            last, before = c[-1], int(at[-1]) + 1
            yield pa.record_batch([*batch.columns, pa.array(at), pa.array(np.full(len(c), part))], names=["c", "key", "n", "at", "part"])

    dealt = rows.repartitionByRange("c", "t", "key").sortWithinPartitions("c", "t", "key").select("c", "key", "n")
    numbered = written(dealt.mapInArrow(number, "c bigint, key binary, n bigint, at bigint, part bigint"), "turns")
    before = F.sum("some").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = numbered.groupBy("c", "part").agg(F.count(F.lit(1)).alias("some")).withColumn("before", before).where("before is not null")
    joined = numbered.join(offsets.drop("some"), ["c", "part"], "left")
    out = written(joined.select("c", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "key", "n"), "ordered-turns")
    discard(numbered)
    return out


def members_of(turns: DataFrame) -> DataFrame:
    """(c, size) of each conversation."""
    return turns.groupBy("c").agg(F.count(F.lit(1)).alias("size"))


def forked(turns: DataFrame, members: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The turns of conversations that begin as the one whose id is the next lower multiple of `every` (towards 0): its first h
    turns, then their own after h, where h = crc32(id) % `most`."""
    h = F.crc32(F.col("c").cast("string")) % most
    base = F.col("c") - F.col("c") % every
    bases = members.where(F.col("c") % every == 0).select(F.col("c").alias("base"), F.col("size").alias("base_size"))
    plan = members.withColumns({"h": h, "base": base})
    heads = turns.where((F.col("c") % every == 0) & (F.col("pos") < most - 1)).withColumnRenamed("c", "base")
    heads = plan.join(heads, "base").where(F.col("pos") < F.col("h")).select("c", "pos", "key", "n")
    # where the base has fewer than h turns, or is absent
    short = plan.join(bases, "base", "left").select("c", F.least("h", F.coalesce("base_size", F.lit(0))).alias("first"), "h")
    short = short.where("first < h").select("c", "first")
    own = turns.withColumn("h", h).where("pos >= h").join(short, "c", "left")
    own = own.select("c", (F.col("pos") - F.col("h") + F.coalesce("first", "h")).alias("pos"), "key", "n")
    return heads.unionByName(own)


# ---------------------------------------------------------------- blocks


def blocks_of(turns: DataFrame, width: int) -> DataFrame:
    """(k, p1, p2, keys, sizes, more, c), written: block k of conversation c, the hash of what precedes it, whether more follows."""
    place = F.struct("pos", "key", "n")
    rows = turns.groupBy("c", F.expr(f"pos div {width}").alias("k")).agg(F.array_sort(F.collect_list(place)).alias("t"))
    rows = written(rows.select("c", "k", F.col("t.key").alias("keys"), F.col("t.n").alias("sizes")), "trie-blocks")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(1).to_numpy()
            ids = np.frombuffer(b"".join(batch.column(2).flatten().to_pylist()), ">u8").reshape(-1, width, 2).astype("u8")
            found = []
            for i, base in enumerate(BASES):
                powers = np.array([pow(base, j, 1 << 64) for j in range(width)], dtype="u8")
                first = np.array([pow(base, int(x) * width, 1 << 64) for x in k], dtype="u8")
                found.append((ids[:, :, i] * powers).sum(axis=1) * first)
            halves = [h.astype("i8") for f in found for h in (f & np.uint64(0xFFFFFFFF), f >> np.uint64(32))]
            yield pa.record_batch([batch.column(0), pa.array(k + 1), *map(pa.array, halves)], names=["c", "k", "l1", "u1", "l2", "u2"])

    full = rows.where(F.size("keys") == width).select("c", "k", "keys")
    schema = "c bigint, k bigint, l1 bigint, u1 bigint, l2 bigint, u2 bigint"
    along = Window.partitionBy("c").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = full.mapInArrow(terms, schema).select("c", "k", *(F.sum(x).over(along).alias(x) for x in ("l1", "u1", "l2", "u2")))

    def mod(low: str, high: str):  # low + 2^32 high modulo 2^64, in halves that can't overflow
        carried = F.col(high) + F.shiftright(low, 32)
        return F.shiftleft(carried.bitwiseAND(F.lit(0xFFFFFFFF)), 32).bitwiseOR(F.col(low).bitwiseAND(F.lit(0xFFFFFFFF)))

    before = sums.select("c", "k", mod("l1", "u1").alias("p1"), mod("l2", "u2").alias("p2"))
    more = rows.where("k > 0").select("c", (F.col("k") - 1).alias("k"), F.lit(True).alias("more"))
    placed = rows.join(more, ["c", "k"], "left").join(before, ["c", "k"], "left")
    zero = F.lit(0).cast("bigint")
    hashes = (F.coalesce(x, zero).alias(x) for x in ("p1", "p2"))
    out = written(placed.select("k", *hashes, "keys", "sizes", F.coalesce("more", F.lit(False)).alias("more"), "c"), "trie-rows")
    discard(rows)
    return out


# ---------------------------------------------------------------- shards


class Matrix:
    """A shard's blocks as a padded matrix of turn numbers, its rows in order."""

    def __init__(self, shard: pa.Table):
        take = {name: shard.column(name).to_numpy() for name in ("k", "p1", "p2", "more", "c")}
        keys = shard.column("keys").combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        sizes = shard.column("sizes").combine_chunks()
        sizes = sizes.chunk(0) if isinstance(sizes, pa.ChunkedArray) else sizes
        length = np.diff(keys.offsets.to_numpy())
        begin = np.cumsum(length) - length
        ids = np.frombuffer(b"".join(keys.flatten().to_pylist()), ">u8").reshape(-1, 2).astype("u8")
        by_id = np.lexsort((ids[:, 1], ids[:, 0]))
        new = np.concatenate([[True], (ids[by_id][1:] != ids[by_id][:-1]).any(axis=1)])
        number = np.empty(len(ids), dtype=np.int32)
        number[by_id] = np.cumsum(new) - 1
        self.ids = ids[by_id][new]
        row = np.repeat(np.arange(len(length)), length)
        cells = np.full((len(length), int(length.max())), -1, dtype=np.int32)
        cells[row, np.arange(len(ids)) - np.repeat(begin, length)] = number
        order = np.lexsort((take["c"], take["more"], *cells.T[::-1], take["p2"], take["p1"], take["k"]))
        self.cells, self.length, self.begin = cells[order], length[order], begin[order]
        self.k, self.p1, self.p2, self.c = (take[x][order] for x in ("k", "p1", "p2", "c"))
        self.last = np.where(take["more"][order], -1, self.length)  # column behind the conversation's last turn
        self.order, self.sizes = order, sizes.flatten().to_numpy()

    def depths(self, width: int) -> Iterator[dict[str, np.ndarray]]:
        """The nodes of each column: first and end row, depth, hash, parent's hash."""
        rows = len(self.c)
        changed = np.ones(rows, dtype=bool)
        changed[1:] = (self.k[1:] != self.k[:-1]) | (self.p1[1:] != self.p1[:-1]) | (self.p2[1:] != self.p2[:-1])
        names, back = np.unique(self.k, return_inverse=True)
        scale = [np.array([pow(b, int(k) * width, 1 << 64) for k in names], dtype="u8")[back] for b in BASES]
        h = [self.p1.view("u8").copy(), self.p2.view("u8").copy()]
        for j in range(self.cells.shape[1]):
            cell = self.cells[:, j]
            changed[1:] |= cell[1:] != cell[:-1]
            first = np.flatnonzero(changed)
            end = np.concatenate([first[1:], [rows]])
            inside = cell[first] >= 0
            first, end = first[inside], end[inside]
            above = [x[first].view("i8") for x in h]
            live = cell >= 0
            for i, base in enumerate(BASES):
                h[i][live] += self.ids[cell[live], i] * scale[i][live] * np.uint64(pow(base, j, 1 << 64))
            own = [x[first].view("i8") for x in h]
            yield {
                "column": j, "first": first, "end": end, "depth": self.k[first] * width + j + 1,
                "h1": own[0], "h2": own[1], "q1": above[0], "q2": above[1],
            }


def between(f: np.ufunc, values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """`f` over each stretch of rows; stretches are in order and don't overlap."""
    if not len(first):
        return values[:0]
    bounds = np.stack([first, end], axis=1).ravel()
    # reduceat takes no index beyond the last row
    return f.reduceat(values, bounds[:-1] if bounds[-1] == len(values) else bounds)[::2]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[Matrix]:
    held = [b for b in batches if b.num_rows]
    if held:
        shard = pa.Table.from_batches(held)
        matrix = Matrix(shard)
        matrix.extra = {n: shard.column(n).to_numpy()[matrix.order] for n in ("owned", "leaf") if n in shard.column_names}
        yield matrix


def _dealt(blocks: DataFrame, turns: int) -> DataFrame:
    n = max(shuffle_partitions(blocks.sparkSession), -(-turns // SHARD))
    return blocks.repartitionByRange(n, "k", "p1", "p2", "keys", "more", "c")


def shard_nodes(blocks: DataFrame, turns: int, width: int) -> DataFrame:
    """Nodes of each shard: depth, hashes, smallest member m, members n, code points of the last text, whether open to other
    shards, and the members that end there: their digest, or their ids if the node is open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in _whole(batches):
            for d in m.depths(width):
                first, end = d["first"], d["end"]
                if not len(first):
                    continue
                is_open = (first == 0) | (end == len(m.c))
                ending = between(np.add, (m.last == d["column"] + 1).astype(np.int64), first, end)
                texts, digests = [None] * len(first), [None] * len(first)
                for i in np.flatnonzero(ending).tolist():
                    text = ",".join(map(str, m.c[first[i] : first[i] + ending[i]].tolist()))
                    if is_open[i]:
                        texts[i] = text
                    else:
                        digests[i] = hashlib.sha256(text.encode()).hexdigest()
                columns = {x: pa.array(d[x]) for x in ("depth", "h1", "h2", "q1", "q2")} | {
                    "m": pa.array(between(np.minimum, m.c, first, end)),
                    "n": pa.array(end - first),
                    "chars": pa.array(m.sizes[m.begin[first] + d["column"]]),
                    "open": pa.array(is_open),
                    "ends": pa.array(digests, pa.string()),
                    "at": pa.array(m.c[first]),
                    "text": pa.array(texts, pa.string()),
                }
                yield pa.record_batch(list(columns.values()), names=list(columns))

    longs = ", ".join(f"{x} bigint" for x in ("depth", "h1", "h2", "q1", "q2", "m", "n", "chars"))
    return _dealt(blocks, turns).mapInArrow(run, f"{longs}, open boolean, ends string, at bigint, text string")


def shard_sums(blocks: DataFrame, turns: int, width: int) -> DataFrame:
    """(depth, h1, h2, owned, leaves) of each shard's nodes with several members, or open to other shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in _whole(batches):
            for d in m.depths(width):
                first, end = d["first"], d["end"]
                some = (end - first > 1) | (first == 0) | (end == len(m.c))
                columns = [pa.array(d[x][some]) for x in NODE]
                columns += [pa.array(between(np.add, m.extra[x], first, end)[some], pa.int64()) for x in ("owned", "leaf")]
                yield pa.record_batch(columns, names=[*NODE, "owned", "leaves"])

    return _dealt(blocks, turns).mapInArrow(run, ", ".join(f"{x} bigint" for x in (*NODE, "owned", "leaves")))


def _joined_ids(members: DataFrame) -> DataFrame:
    """(at, text): the ids of column c in ascending order, as pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = ",".join(map(str, batch.column(0).to_pylist()))
                yield pa.record_batch([batch.column(0).slice(0, 1), pa.array([text])], names=["at", "text"])

    return members.select("c").repartitionByRange("c").sortWithinPartitions("c").mapInArrow(run, "at bigint, text string")


def _digests(pieces: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends): the digest of each node's pieces, joined in order; one piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def done() -> pa.RecordBatch:
            return pa.record_batch([*(pa.array([x], pa.int64()) for x in last), pa.array([state.hexdigest()])], names=[*NODE, "ends"])

        for batch in batches:
            for i in range(batch.num_rows):
                node = tuple(batch.column(j)[i].as_py() for j in range(3))
                if node != last:
                    if last is not None:
                        yield done()
                    last, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(batch.column(3)[i].as_py().encode())
        if last is not None:
            yield done()

    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "at").select(*NODE, "text")
    return dealt.mapInArrow(run, "depth bigint, h1 bigint, h2 bigint, ends string")


# ---------------------------------------------------------------- the trie


def trie(turns: DataFrame, members: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the trie of the conversations `members` (c) with `turns` (c, pos, key, n; positions from 0 on): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = blocks_of(turns, width)
    total = blocks.agg(F.sum(F.size("keys"))).first()[0] or 0
    parts = written(shard_nodes(blocks, total, width), "trie-parts")

    zero = F.lit(0).cast("bigint")
    root = [zero.alias(x) for x in NODE]
    turnless = members.select("c").join(blocks.where("k = 0").select("c"), "c", "left_anti")
    pieces = parts.where("open and text is not null").select(*NODE, "at", "text")
    pieces = pieces.unionByName(_joined_ids(turnless).select(*root, "at", "text"))
    names = [*NODE, "q1", "q2", "m", "n", "chars"]
    crossing = parts.where("open").groupBy(*NODE, "q1", "q2").agg(F.min("m").alias("m"), F.sum("n").alias("n"), F.max("chars").alias("chars"))
    top = members.agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n")).where("n > 0")
    top = top.select(*root, zero.alias("q1"), zero.alias("q2"), "m", "n", zero.alias("chars"))
    again = crossing.select(names).unionByName(top).join(_digests(pieces), NODE, "left")
    closed = parts.where("not open").select(*names, "ends")
    children = F.col("depth") > 0
    nodes = written(closed.unionByName(again.select(*names, "ends")), "trie-nodes")
    n_children = nodes.where(children).groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("h1"), F.col("q2").alias("h2"))
    n_children = n_children.agg(F.count(F.lit(1)).alias("n_children"))
    saved = ((F.col("n") - 1) * F.col("chars")).alias("saved")
    counted = nodes.join(n_children, NODE, "left").select(*names, "ends", F.coalesce("n_children", zero).alias("n_children"), saved)
    counted = written(counted, "trie-counted")

    # what each conversation owns, and its sum over the members of each node
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    owned = counted.groupBy("m").agg(F.sum("saved").alias("owned"), F.sum(leaf).alias("leaf"))
    given = blocks.join(owned.withColumnRenamed("m", "c"), "c", "left")
    given = given.withColumns({x: F.coalesce(x, zero) for x in ("owned", "leaf")})
    sums = shard_sums(given, total, width).groupBy(*NODE).agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"))
    # the root: all conversations; one without turns owns nothing below it
    sums = sums.unionByName(owned.agg(F.sum("owned").alias("owned"), F.sum("leaf").alias("leaves")).select(*root, "owned", "leaves"))
    # what its smallest member owns above a node that others share
    shared = counted.where("n > 1").select(*NODE, "m", "saved", F.expr(f"depth div {STRETCH}").alias("g"))
    above = Window.partitionBy("m", "g").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("m").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    stretches = shared.groupBy("m", "g").agg(F.sum("saved").alias("some")).withColumn("far", F.sum("some").over(far)).where("far is not null")
    higher = shared.withColumn("near", F.coalesce(F.sum("saved").over(above), zero)).join(stretches.select("m", "g", "far"), ["m", "g"], "left")
    higher = higher.select(*NODE, (F.col("near") + F.coalesce("far", zero)).alias("higher"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("m").alias("parent"))
    out = counted.join(sums, NODE, "left").join(higher, NODE, "left").join(parents, ["depth", "q1", "q2"], "left")
    alone = F.col("n") == 1
    no_end = hashlib.sha256(b"").hexdigest()
    out = written(
        out.select(
            F.col("m").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            "n_children",
            F.when(alone, 1).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
            F.when(alone, zero).otherwise(F.col("owned") - F.coalesce("higher", zero)).alias("saved_tokens"),
            F.coalesce("ends", F.lit(no_end)).alias("ends_sha256"),
        ),
        "trie",
    )
    discard(blocks, parts, nodes, counted)
    return out


def conversation_trie(convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of the conversations as `forked` rebuilds them."""
    turns = ordered(convs)
    members = written(members_of(turns), "conversations")
    out = trie(forked(turns, members), members, width)
    discard(turns, members)
    return out
