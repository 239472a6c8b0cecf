"""The trie of conversations against one built by hand."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from docloom.llm import turntrie
from docloom.llm.turntrie import conversation_trie, forked, members_of, ordered, trie

from .conftest import prose

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def sequences(rows):
    """conv_id -> [(role, text)] in order; ties by the digest of the turn."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[c].append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [t[2] for t in sorted(turns)] for c, turns in found.items()}


def fork(convs):
    def truncated(c):
        return int(c / 100) * 100

    def h(c):
        return zlib.crc32(str(c).encode()) % 6

    return {c: convs.get(truncated(c), [])[: h(c)] + turns[h(c) :] for c, turns in convs.items()}


def brute(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), children[path], leaves[path], saved[path], digest))
    return sorted(out, key=str)


def got(df):
    assert df.columns == COLUMNS
    assert {t for _, t in df.dtypes} == {"bigint", "string"}
    return sorted((tuple(r) for r in df.collect()), key=str)


def tuples(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture
def talks(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


ODD = [
    (0, 0, "user", "a"), (0, 1, "bot", "b"), (0, 2, "user", "c"), (0, 3, "bot", "d"), (0, 4, "user", "e"), (0, 5, "bot", "f"),
    *((c, t, "user" if t % 2 == 0 else "bot", "abcdefgh"[t] if t < 3 or c % 3 else "z") for c in range(1, 30) for t in range(c % 8)),
    (30, None, None, None), (30, None, "x", None), (30, 0, None, "first"), (30, 0, None, "other"), (30, 7, "r", "u"), (30, 7, "r", "u"),
    (250, 0, "u", "no base"), (251, 0, "u", "no base"), (251, 1, "u", "x"), (252, 5, "", "y"),
    (300, 0, "u", "short base"), *((301 + i, t, "u", "t" * t) for i in range(9) for t in range(6)),
    (-7, 0, "u", "negative"), (-7, 3, "u", "n"), (-100, 0, "u", "base"), (-100, 1, "u", "é\U0001f600"), (-250, 1, "u", "é\U0001f600"),
    (None, 0, "u", "nobody"), (None, 1, "u", "nobody"), (2**40, 0, "a", "b"), (2**40 + 1, 0, "", "ab"), (2**40 + 2, 0, "ab", ""),
    (7, 99, "u", prose(4, 3000)),
]


def test_given_conversations(talks):
    assert got(conversation_trie(talks)) == brute(fork(sequences(tuples(talks))))


@pytest.mark.parametrize("width,shard", [(32, 1 << 19), (1, 5), (2, 40), (3, 1)])
def test_odd_conversations(spark, monkeypatch, width, shard):
    """Also with narrow blocks, many shards, and few nodes in a stretch."""
    monkeypatch.setattr(turntrie, "SHARD", shard)
    monkeypatch.setattr(turntrie, "STRETCH", 2 if width < 32 else 1 << 12)
    convs = spark.createDataFrame(ODD, SCHEMA)
    assert got(conversation_trie(convs, width)) == brute(fork(sequences(ODD)))


def test_clashing_names(spark):
    convs = spark.createDataFrame(ODD, SCHEMA)
    names = ("c", "t", "key", "n", "pos", "k", "p1", "h", "m", "depth", "at", "part", "size")
    assert got(conversation_trie(convs.selectExpr("*", *(f"'{x}' as `{x}`" for x in names)))) == got(conversation_trie(convs))


def test_no_conversations(spark):
    assert got(conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    assert got(conversation_trie(spark.createDataFrame([(None, 0, "u", "x")], SCHEMA))) == []


def test_only_turnless(spark):
    """One turn and a head of several turns from an absent base leave nothing."""
    ids = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0][:5]
    rows = [(c, 0, "u", "x") for c in ids]
    digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == [(ids[0], 0, None, 5, 0, 1, 0, digest)]


def test_long_and_equal_conversations(spark, monkeypatch):
    """One conversation of 500 turns, 400 equal ones, and a common first turn, dealt over many small shards."""
    monkeypatch.setattr(turntrie, "SHARD", 64)
    monkeypatch.setattr(turntrie, "STRETCH", 16)
    rows = [(1, t, "u", f"turn {t}") for t in range(500)] + [(2, t, "u", f"turn {t}") for t in range(470)]
    rows += [(c, t, "u", f"turn {t}") for c in range(1000, 1400) for t in range(5)]
    rows += [(c, t, "u", "turn 0" if t == 0 else f"{c} {t}") for c in range(2000, 2100) for t in range(3)]
    convs = spark.createDataFrame(rows, SCHEMA)
    turns = ordered(convs)
    want = sequences(rows)
    assert got(trie(turns, members_of(turns), 4)) == brute(want)
    found = defaultdict(dict)
    for r in forked(turns, members_of(turns)).collect():
        found[r["c"]][r["pos"]] = r["n"]
    assert {c: [n for _, n in sorted(p.items())] for c, p in found.items()} == {
        c: [len(t) for _, t in s] for c, s in fork(want).items() if s
    }
    assert all(sorted(p) == list(range(len(p))) for p in found.values())
