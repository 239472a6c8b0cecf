"""Grouping, settling, positions and value differences against plain Python."""

import datetime
import random
from collections import defaultdict

from pyspark.sql import functions as F

from docloom.operators import pending, positions, settling, valuediff

START = datetime.datetime(2024, 5, 6, 8, 0, 0)


def arrivals(seed, n):
    """(index, document, time) in order of arrival; times may go back."""
    rng = random.Random(seed)
    return [
        (rng.choice("xy"), rng.randrange(6), START + datetime.timedelta(seconds=rng.randrange(1000))) for _ in range(n)
    ]


def changes(spark, rows):
    data = [(i, d, n, 0, 0, 0, n // 2, ts) for n, (i, d, ts) in enumerate(rows)]
    return spark.createDataFrame(
        data,
        "index string, doc_id bigint, seq bigint, rule_id int, row_no int, sub_no int, event_id bigint, ts timestamp",
    ).repartition(3)


def grouped(rows):
    """(index, document) -> rows, time of the first arrival, latest time, first and last position."""
    out = {}
    for n, (i, d, ts) in enumerate(rows):
        k, first, last, lo, _ = out.get((i, d), (0, ts, ts, n, n))
        out[i, d] = (k + 1, first, max(last, ts), lo, n)
    return out


def as_grouped(df):
    return {
        (r["index"], r["doc_id"]): (r["n_rows"], r["first_ts"], r["last_ts"], r["first_seq"], r["last_seq"])
        for r in df.collect()
    }


def test_grouping_of_generated_arrivals(spark):
    for n in (1, 2, 17, 300):
        rows = arrivals(n, n)
        assert as_grouped(pending.doc_batches(changes(spark, rows))) == grouped(rows)


def test_merged_batches_equal_one_grouping(spark):
    rows = arrivals(3, 120)
    df = changes(spark, rows)
    for cut in (1, 40, 119):
        parts = [pending.doc_batches(df.where(f"seq < {cut}")), pending.doc_batches(df.where(f"seq >= {cut}"))]
        assert as_grouped(pending.merge_batches(parts[1].unionByName(parts[0]))) == grouped(rows)
    stats = {r["index"]: (r["n_docs"], r["n_rows"]) for r in pending.queue_stats(pending.doc_batches(df)).collect()}
    want = {i: (len({d for j, d, _ in rows if j == i}), sum(j == i for j, _, _ in rows)) for i in "xy"}
    assert stats == want


def test_split_and_safe_position(spark):
    day = datetime.datetime(2024, 7, 1)
    at = lambda s: day + datetime.timedelta(seconds=s)
    rows = [("x", 1, at(0)), ("x", 1, at(95)), ("x", 2, at(80)), ("y", 2, at(98)), ("y", 3, at(89)), ("x", 4, at(99))]
    split = pending.settle_split(
        pending.doc_batches(changes(spark, rows)), F.lit(at(100)), gap_seconds=10, hold_seconds=60
    ).cache()
    ready = {(r["index"], r["doc_id"]) for r in split.where("ready").collect()}
    assert ready == {("x", 1), ("x", 2), ("y", 3)}
    waiting = split.where("NOT ready")
    assert {(r["index"], r["doc_id"]) for r in waiting.collect()} == {("y", 2), ("x", 4)}
    assert pending.safe_position(waiting, F.lit(77)).first()[0] == 1
    assert pending.safe_position(split.where("doc_id > 100"), F.lit(77)).first()[0] == 77
    picked = pending.changes_of(changes(spark, rows), split.where("ready"))
    assert {r["seq"] for r in picked.collect()} == {0, 1, 2, 4}


def test_empty_queue(spark):
    df = changes(spark, arrivals(1, 3)).where("doc_id < 0")
    assert pending.settle_split(pending.doc_batches(df), F.current_timestamp(), 1, 10).count() == 0


def test_positions(spark):
    rng = random.Random(3)
    marks = [rng.random() < 0.2 for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(marks)), "seq bigint, m boolean").repartition(5)
    got = {r["seq"]: r["event_id"] for r in positions.tag_positions(df, F.col("m"), block=37).collect()}
    assert got == {n: sum(marks[: n + 1]) for n in range(500)}
    assert positions.resume_after(df, 490).count() == 9
    assert positions.resume_after(df, None).count() == 500
    assert positions.already_applied(df, 490).count() == 491


def test_net_values(spark):
    rng = random.Random(5)
    rows, plain, sets = [], {}, defaultdict(dict)
    for n in range(3000):
        # one key and one value hold a third of all rows
        k = 0 if rng.random() < 0.33 else rng.randrange(1, 12)
        old, new = (("hot" if rng.random() < 0.33 else rng.choice(["a", "b", None])) for _ in range(2))
        rows.append((k, n, old, new))
        plain[k] = (plain.get(k, (old,))[0], new)
        if old != new:
            for v, d in ((old, -1), (new, 1)):
                if v is not None:
                    sets[k][v] = max(-1, min(1, sets[k].get(v, 0) + d))
    df = spark.createDataFrame(rows, "k int, n bigint, o string, w string").repartition(4)
    got = {r["k"]: (r["old_value"], r["new_value"]) for r in valuediff.net_plain_value(df, ["k"], "n", "o", "w").collect()}
    assert got == {k: v for k, v in plain.items() if v[0] != v[1]}
    for block, levels in ((1, 2), (10, 3), (1000000, 1)):
        net = valuediff.net_set_value(df, ["k"], "n", "o", "w", block=block, levels=levels)
        got = {(r["k"], r["value"]): r["net"] for r in net.collect()}
        assert got == {(k, v): s for k, vs in sets.items() for v, s in vs.items() if s}


def replay(times, gap, hold, flush):
    """Batches of one document by walking through the flush ticks."""
    out, queue, todo = [], [], sorted(times)
    tick = -(-todo[0] // flush)
    while todo or queue:
        while todo and -(-todo[0] // flush) <= tick:
            queue.append(todo.pop(0))
        if queue and (tick * flush - queue[-1] >= gap or tick * flush - queue[0] >= hold):
            out.append((queue[0], queue[-1], len(queue), tick * flush))
            queue = []
        tick += 1
    return out


def test_settle_batches(spark):
    rng = random.Random(9)
    start = 1_700_000_000
    docs = {d: sorted(start + rng.randrange(0, 2000) for _ in range(rng.choice([1, 5, 300]))) for d in range(25)}
    docs[99] = [start + n for n in range(1500)]  # never quiet, and most of the rows
    flat = sorted((t, d) for d, ts in docs.items() for t in ts)
    rows = [("i", d, datetime.datetime.fromtimestamp(t)) for t, d in flat]
    got = defaultdict(list)
    for r in settling.settle_batches(changes(spark, rows), 20, 90, 7).orderBy("doc_id", "batch_no").collect():
        got[r["doc_id"]].append((r["first_us"] // 10**6, r["last_us"] // 10**6, r["n_rows"], r["flush_us"] // 10**6))
    assert dict(got) == {d: replay(ts, 20, 90, 7) for d, ts in docs.items()}
