"""The follower's own bookkeeping: where it starts, which files it opens, and what it leaves behind."""

import os

from pyspark.sql import functions as F

from docloom.operators.positions import tag_positions
from docloom.operators.rules import route, touched
from docloom.plans.commits import content_digests, parts_apart
from docloom.sources.feed import read_feed, write_feed

from test_streaming import RULE, Setup, base, feed
from test_target import decided, docs, table


def noted_step(s, follower, batch_id, *rows):
    """One micro-batch as the stream brings it, with the file that each change came in."""
    path = f"{s.root}/table=t"
    local = path.removeprefix("file:")
    known = set(os.listdir(local)) if os.path.isdir(local) else set()
    write_feed([feed(s.spark, *rows)], s.root)
    new = sorted(f"{path}/{n}" for n in set(os.listdir(local)) - known if n.endswith(".parquet"))
    (stored,) = read_feed(s.spark, s.root, {"t": ["k"]})
    stored = type(stored)("t", s.spark.read.schema(stored.df.schema).parquet(*new), ("k",))
    arrived = touched(route([stored], [RULE])).select("index", "table", "doc_id", "seq", "event_id", F.input_file_name().alias("file"))
    follower.on_batch(arrived, batch_id)
    return follower.last["ready"], follower.last["waiting"]


def opened(follower, batch_id, lo, hi):
    return sum(len(f.df.inputFiles()) for f in follower._changes(batch_id, lo, hi))


def test_only_files_of_the_range_are_opened(spark, monkeypatch):
    s = Setup(spark, base(spark, (1, 1, "a"), (2, 2, "b")))
    s.frames = base(spark, (1, 9, "a"), (2, 6, "b"), (3, 3, "c"))
    f = s.follower()
    assert noted_step(s, f, 0, (1, "update", (1, 1, "a"), (1, 5, "a"))) == (0, 1)
    monkeypatch.setattr(f, "_stored", lambda: (_ for _ in ()).throw(AssertionError("the whole feed is read")))
    f._schemas = {"t": read_feed(spark, s.root, {"t": ["k"]})[0].df.schema}
    s.now[0] += 6
    assert noted_step(s, f, 1, (2, "update", (2, 2, "b"), (2, 6, "b"))) == (0, 2)
    s.now[0] += 6  # document 1 has settled
    assert noted_step(s, f, 2, (3, "insert", None, (3, 3, "c"))) == (1, 2)
    assert s.content() == {1: (9, "a"), 2: (2, "b")}
    files = opened(f, 2, 1, 3)
    assert files >= 3 and opened(f, 2, 1, 1) < files and opened(f, 2, 50, 60) == 0
    s.now[0] += 20
    assert noted_step(s, f, 3, (4, "update", (1, 5, "a"), (1, 9, "a"))) == (2, 1)
    assert s.content() == {1: (9, "a"), 2: (6, "b"), 3: (3, "c")}
    assert opened(f, 3, 0, 1) == 0  # its change was applied, so its file is forgotten
    s.now[0] += 20
    assert noted_step(s, f, 4, (5, "insert", None, (3, 3, "c"))) == (1, 1)
    assert s.targets[0].current().seq == 4


def test_a_new_follower_starts_at_a_position(spark):
    s = Setup(spark, base(spark, (1, 1, "a"), (2, 2, "b")), start_after=2)
    before = [(1, "update", (1, 0, "a"), (1, 1, "a")), (2, "insert", None, (2, 2, "b"))]
    write_feed([feed(spark, *before, (3, "update", (2, 2, "b"), (2, 8, "b")))], s.root)
    s.frames = base(spark, (1, 77, "a"), (2, 8, "b"))
    f = s.follower()
    f.gap_seconds = 0
    query = f.start(heartbeat=False, trigger={"availableNow": True})
    query.awaitTermination(120)
    assert f.metrics().groupBy().sum("arrived").first()[0] == 1
    assert s.content() == {1: (1, "a"), 2: (8, "b")}  # document 1 has changed at or before the start only
    assert s.targets[0].current().seq == 3


def test_a_quiet_table_counts_as_seen_up_to_the_start(spark):
    s = Setup(spark, base(spark, (1, 1, "a")), start_after=7)
    write_feed([feed(spark, (1, "insert", None, (1, 1, "a")))], s.root)
    f = s.follower()
    noted_step(s, f, 0, (3, "insert", None, (1, 1, "a")))
    s.now[0] += 60
    f._frontier(0)
    assert f._frontier(0)[0] == 3  # what was seen counts before the start does
    empty = s.follower()
    empty.state_dir += "-new"
    (stored,) = read_feed(spark, s.root, {"t": ["k"]})
    none = touched(route([stored], [RULE])).select("index", "table", "doc_id", "seq", "event_id").where("seq < 0")
    empty.on_batch(none, 0)
    assert empty._frontier(0)[0] == 7


def test_what_is_left_behind_is_bounded(spark):
    """With upkeep, neither folders of counters nor versions nor queues grow with the number of micro-batches."""
    s = Setup(spark, base(spark, (1, 1, "a")), upkeep_every=3, keep_versions=4)
    f = s.follower()
    f.gap_seconds = 0
    shared = set(os.listdir(os.path.dirname(s.root).removeprefix("file:")))
    for n in range(9):
        s.frames = base(spark, (1, n, "a"))
        s.now[0] += 1
        assert noted_step(s, f, n, (n + 1, "update", (1, 0, "a"), (1, n, "a"))) == (1, 0)
    state = s.state.removeprefix("file:")
    assert len(os.listdir(f"{state}/metrics")) <= 3
    assert all(len(os.listdir(f"{state}/{x}")) <= 2 for x in ("queue", "seen", "files"))
    assert len(s.targets[0].versions()) <= 4
    assert {r["batch_id"] for r in f.metrics().collect()} == set(range(9)) and f.metrics().count() == 9
    new = set(os.listdir(os.path.dirname(s.root).removeprefix("file:"))) - shared
    assert new == {os.path.basename(s.root), os.path.basename(s.state)}  # the feed and the follower's own, nothing staged
    assert s.content() == {1: (8, "a")}


def test_replicas_compared_by_content(spark):
    a, b, c = table(spark), table(spark), table(spark)
    rows = [(i, i % 3, f"t{i}") for i in range(40)]
    a.rebuild(docs(spark, *rows), "id", 4)
    b.rebuild(docs(spark, *rows[::-1]).repartition(5), "id", 4)
    c.rebuild(docs(spark, *rows[:30]), "id", 4)
    c.apply(decided(spark, *((i, "replace", ["t"], i % 3, f"t{i}") for i in range(30, 40))), batch_id=1)
    assert parts_apart(spark, {"a": a, "b": b, "c": c}).count() == 0
    assert content_digests(spark, {"a": a}).agg(F.sum("n_docs")).first()[0] == 40
    b.apply(decided(spark, (5, "replace", ["t"], 5 % 3, "other")), batch_id=1)  # one attribute of one document
    c.apply(decided(spark, (44, "replace", ["t"], 1, "more"), (2, "delete", ["t"], None, None)), batch_id=2)
    apart = {r["part"]: {t["target"]: t["n_docs"] for t in r["targets"]} for r in parts_apart(spark, {"a": a, "b": b, "c": c}).collect()}
    assert apart == {0: {"a": 10, "b": 10, "c": 11}, 1: {"a": 10, "b": 10, "c": 10}, 2: {"a": 10, "b": 10, "c": 9}}
    # null is no value, and an empty part is a state
    d, e = table(spark), table(spark)
    d.rebuild(docs(spark, (1, None, "x")), "id", 4)
    e.rebuild(docs(spark, (1, 0, "x"), (2, 0, "y")), "id", 4)
    assert {r["part"] for r in parts_apart(spark, {"d": d, "e": e}).collect()} == {1, 2}


def test_tags_of_sparse_and_missing_positions(spark):
    """Positions far apart are no more work than dense ones; rows without one come first."""
    rows = [(None, True, -1)] + [(n * 10**12, n % 7 == 0, n) for n in range(700)]
    df = spark.createDataFrame(rows, "seq bigint, m boolean, n int").repartition(6)
    for block in (None, 50, 10**6):
        tagged = tag_positions(df, F.col("m"), block=block)
        got = {r["n"]: r["event_id"] for r in tagged.collect()}
        assert got == {-1: 1, **{n: 2 + n // 7 for n in range(700)}}
    plan = tag_positions(df, F.col("m"), block=50)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    assert len(windows) == 2 and sum("[_range" in w.split("windowspecdefinition")[1] for w in windows) >= 1
