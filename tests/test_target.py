"""The document table: versions, change batches, compaction; sync batches, rebuilds, recovery."""

import pytest
from pyspark.sql import functions as F

from docloom.operators.rules import IngestRule, TableFeed
from docloom.operators.source import DocSource
from docloom.plans import maintenance
from docloom.plans.commits import applied_up_to, commits, replicas_agree
from docloom.plans.rebuild import RebuildInProgress, RebuildLog, rebuild_and_replay, rebuild_group, rebuild_unless
from docloom.plans.recovery import recover, recovery_plan
from docloom.plans.sync import SyncJob, sync_batch
from docloom.plans.target import DocTable, TableNotReady, WriteConflict, _by_part, staged_by_part
from docloom.session import new_dir, staged
from docloom.workload.inputs import Inputs
from docloom.workload.orders import ORDER_DOC

DOC = "id bigint, a bigint, t string"


def table(spark):
    return DocTable(spark, new_dir(spark, "t"))


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOC)


def decided(spark, *rows):
    """(doc_id, action, attrs, a, t)"""
    return spark.createDataFrame(
        [(d, 0, act, attrs, None if act == "delete" else (a, t)) for d, act, attrs, a, t in rows],
        "doc_id bigint, part int, action string, attrs array<string>, doc struct<a: bigint, t: string>",
    )


def content(t, **how):
    return {r["id"]: (r["a"], r["t"]) for r in t.read(**how).collect()}


def test_versions(spark):
    t = table(spark)
    assert t.current() is None
    with pytest.raises(TableNotReady):
        t.read()
    t.rebuild(docs(spark, (1, 1, "x"), (2, 2, "y"), (5, 5, "z")), "id", 4, seq=10)
    assert content(t) == {1: (1, "x"), 2: (2, "y"), 5: (5, "z")}
    v = t.apply(
        decided(spark, (2, "delete", ["a"], None, None), (5, "replace", ["t"], 6, "zz"), (7, "replace", ["t"], 7, "n")),
        batch_id=1, seq=20, event_id=3,
    )
    assert (v.n_replace, v.n_update, v.n_delete, v.seq, v.event_id) == (2, 0, 1, 20, 3)
    assert content(t) == {1: (1, "x"), 5: (6, "zz"), 7: (7, "n")}
    assert content(t, version=1) == {1: (1, "x"), 2: (2, "y"), 5: (5, "z")}
    assert content(t, parts=[1]) == {1: (1, "x"), 5: (6, "zz")}
    ids = spark.createDataFrame([(2,), (7,), (1,)], "doc_id bigint")
    assert content(t, ids=ids) == {1: (1, "x"), 7: (7, "n")}

    # a document that was deleted comes back, another goes
    t.apply(decided(spark, (2, "replace", ["t"], 22, "b"), (7, "delete", ["t"], None, None)), batch_id=2)
    want = {1: (1, "x"), 2: (22, "b"), 5: (6, "zz")}
    assert content(t) == want
    # a batch that is there already is skipped
    assert t.apply(decided(spark, (1, "delete", ["a"], None, None)), batch_id=2).version == 3
    assert content(t) == want and t.current().seq == 20

    maintenance.compact_if_needed(t, 0)
    assert t.current().version == 3
    assert len(t.current().delta) == 2
    v = maintenance.compact_if_needed(t, 0, max_deltas=1)
    assert v.kind == "merge" and len(v.delta) == 1 and content(t) == want
    t.compact([2])
    assert content(t) == want and t.current().kind == "compact" and t.current().batch_id == 2
    maintenance.compact_if_needed(t, 1)
    assert content(t) == want and t.current().delta == {}
    assert content(t, version=3) == want
    status = {r["part"]: (r["n_docs"], r["delta_bytes"]) for r in maintenance.part_status(t).collect()}
    assert status == {1: (2, 0), 2: (1, 0)}
    t.set_position(5, 1)
    assert t.current().seq == 5 and content(t) == want
    assert t.trim_history(2) == [1, 2, 3, 4, 5]
    assert content(t) == want


def test_partial_updates(spark):
    def fresh():
        t = table(spark)
        t.rebuild(docs(spark, (1, 1, "old"), (2, 2, "old")), "id", 2)
        return t

    change = decided(spark, (1, "update", ["a"], 10, "new"), (9, "update", ["a"], 90, "new"))
    strict, healing = fresh(), fresh()
    strict.apply(change, upsert_missing=False)
    assert content(strict) == {1: (10, "old"), 2: (2, "old")}  # nothing to update for document 9
    healing.apply(change)
    assert content(healing) == {1: (10, "new"), 2: (2, "old"), 9: (90, "new")}


def test_failed_write_changes_nothing(spark):
    t = table(spark)
    t.rebuild(docs(spark, (1, 1, "x")), "id", 2)
    boom = F.udf(lambda v: 1 // 0, "bigint")
    with pytest.raises(Exception):
        t.apply(decided(spark, (1, "replace", ["t"], 1, "y")).withColumn("action", boom("doc_id").cast("string")), batch_id=1)
    with pytest.raises(Exception):
        t.rebuild(docs(spark, (1, 1, "z")).withColumn("a", boom("a")), "id", 2)
    assert content(t) == {1: (1, "x")} and t.current().version == 1
    t.apply(decided(spark, (1, "replace", ["t"], 1, "y")), batch_id=1)
    assert content(t) == {1: (1, "y")}


def test_two_rebuilds_at_once(spark):
    """Each has its own files; the one that is published last stands, whole."""
    t = table(spark)
    a = t.build(docs(spark, (1, 1, "x")), "id", 1)
    b = t.build(docs(spark, (1, 1, "y"), (2, 2, "y")), "id", 1)
    t.publish(a)
    assert content(t) == {1: (1, "x")}
    t.publish(b)
    assert content(t) == {1: (1, "y"), 2: (2, "y")}
    assert content(t, version=1) == {1: (1, "x")}


class Interrupted:
    """Makes `meanwhile` happen after the files of the next write are there and before they are published."""

    def __init__(self, t, meanwhile):
        self.t, self.meanwhile, self.write = t, meanwhile, t._write

    def __enter__(self):
        def write(*a):
            out = self.write(*a)
            self.t._write = self.write
            self.meanwhile()
            return out

        self.t._write = write

    def __exit__(self, *_):
        self.t._write = self.write


def test_two_batches_at_once(spark):
    """The later one fails, and neither its documents nor the loss of the other's can be read."""
    t, other = table(spark), None
    t.rebuild(docs(spark, (1, 1, "x")), "id", 1)
    other = DocTable(spark, t.root)
    first = decided(spark, (1, "replace", ["t"], 1, "first"))
    with Interrupted(t, lambda: other.apply(first, batch_id=1)), pytest.raises(WriteConflict):
        t.apply(decided(spark, (9, "replace", ["t"], 9, "second")), batch_id=1)
    assert content(t) == content(other) == {1: (1, "first")}
    t.apply(decided(spark, (9, "replace", ["t"], 9, "second")), batch_id=2)
    assert content(t) == {1: (1, "first"), 9: (9, "second")}


def test_upkeep_beside_batches(spark):
    t = table(spark)
    t.rebuild(docs(spark, (1, 1, "x"), (2, 2, "x")), "id", 2)
    t.apply(decided(spark, (1, "replace", ["t"], 1, "y")), batch_id=1)
    t.apply(decided(spark, (2, "replace", ["t"], 2, "y")), batch_id=2)
    other = DocTable(spark, t.root)
    # a batch comes while deltas are merged, and while parts are compacted
    with Interrupted(t, lambda: other.apply(decided(spark, (1, "delete", ["t"], None, None)), batch_id=3)):
        t.merge_deltas()
    assert content(t) == {2: (2, "y")} and len(t.current().delta) == 2
    with Interrupted(t, lambda: other.apply(decided(spark, (2, "replace", ["t"], 2, "z")), batch_id=4)):
        t.compact([0, 1])
    assert content(t) == {2: (2, "z")} and t.current().kind == "compact" and t.current().batch_id == 4
    # upkeep comes while a batch is applied
    with Interrupted(t, lambda: other.compact([0, 1])):
        t.apply(decided(spark, (1, "replace", ["t"], 1, "back")), batch_id=5)
    assert content(t) == {1: (1, "back"), 2: (2, "z")}
    # files that were folded elsewhere meanwhile
    with Interrupted(t, lambda: other.compact([0, 1])), pytest.raises(WriteConflict):
        t.compact([0, 1])
    assert content(t) == {1: (1, "back"), 2: (2, "z")}


def test_a_new_stream_counts_anew(spark):
    t = table(spark)
    t.rebuild(docs(spark, (1, 1, "x")), "id", 1)
    t.apply(decided(spark, (1, "replace", ["t"], 1, "y")), batch_id=5, stream="a")
    t.apply(decided(spark, (1, "replace", ["t"], 1, "skipped")), batch_id=5, stream="a")
    assert content(t) == {1: (1, "y")}
    t.apply(decided(spark, (1, "replace", ["t"], 1, "z")), batch_id=0, stream="b")
    assert content(t) == {1: (1, "z")}


def test_a_version_file_that_was_never_filled(spark):
    t = table(spark)
    t.rebuild(docs(spark, (1, 1, "x")), "id", 1, seq=3)
    fs, p = t._fs(f"{t.root}/versions/{2:012d}.json")
    fs.create(p, False).close()
    assert content(t) == {1: (1, "x")} and t.current().version == 1
    assert t.apply(decided(spark, (1, "replace", ["t"], 1, "y")), batch_id=1).version == 3
    assert content(t) == {1: (1, "y")}
    assert commits(spark, {"t": t}).count() == 2


def test_old_files_go(spark):
    t = table(spark)
    t.rebuild(docs(spark, (1, 1, "x")), "id", 1)
    for n in range(6):
        t.apply(decided(spark, (1, "replace", ["t"], n, "y")), batch_id=n)
        t.merge_deltas()
        t.trim_history(2)
    kept = {w for v in t.versions() for k in ("base", "delta") for w in getattr(t.current(v), k)}
    stored = [
        f"{v.partition('=')[2]}-{w.partition('=')[2]}"
        for k in ("base", "delta")
        for v in t._names(f"{t.root}/{k}")
        for w in t._names(f"{t.root}/{k}/{v}")
    ]
    assert sorted(stored) == sorted(kept) and len(stored) <= 4
    assert content(t) == {1: (5, "y")}


def test_readiness(spark):
    t = table(spark)
    rows = docs(spark, (1, 1, "x"), (2, 2, "y"))
    assert not t.is_ready(rows.schema)
    v = t.rebuild(rows, "id", 2)
    assert t.is_ready(rows.schema, "id", 2)
    assert not t.is_ready(rows.schema, "a", 2) and not t.is_ready(rows.schema, "id", 3)
    assert not t.is_ready(rows.drop("t").schema, "id", 2)
    (write,) = v.base
    fs, p = t._fs(f"{t._folder('base', write)}/doc_part=1")
    fs.delete(p, True)
    assert not t.is_ready(rows.schema, "id", 2)


def test_several_rows_for_one_document(spark):
    """They fail, or the last one by the declared order is taken, by a rebuild and by a batch alike."""
    frames = {"t": spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (2, 1, "c")], "k bigint, v bigint, s string")}
    query = "SELECT t.k AS `id:id`, t.v AS `v:attr_uint`, t.s AS `s:field` FROM {t} t"
    for latest in (None, "v"):
        source = DocSource("d", query, {"t": "k"}, parts=2, latest=latest)
        job = SyncJob({"d": source}, [RULE], {"d": [table(spark)]})
        (t,) = job.targets["d"]
        log = RebuildLog(spark, new_dir(spark, "l"))
        if latest is None:
            with pytest.raises(Exception, match="several rows"):
                rebuild_group(spark, job, frames, log, seq=0)
            continue
        rebuild_group(spark, job, frames, log, seq=0)
        want = [(1, 6, "b"), (2, 1, "c")]
        assert sorted(map(tuple, t.read().collect())) == want
        for n in range(2):
            sync_batch(spark, job, frames, small_feed(spark, (n, "update", (1, n, "a"), (1, 9, "a"))), batch_id=n, seq=n)
            assert sorted(map(tuple, t.read().collect())) == want


def test_one_part_and_empty_table(spark):
    t = table(spark)
    t.rebuild(docs(spark, (1, 1, "x")).where("id > 5"), "id", 3)
    assert content(t) == {}
    t.rebuild_part(docs(spark, (4, 4, "x"), (7, 7, "y")), 1)
    assert content(t) == {4: (4, "x"), 7: (7, "y")}
    with pytest.raises(ValueError, match="parts"):
        t.rebuild_part(docs(spark, (5, 5, "x")), 1)
    t.apply(decided(spark, (4, "delete", ["a"], None, None), (7, "delete", ["a"], None, None)))
    assert content(t) == {}


# sync ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("cuts", [1, 3])
def test_any_split_of_the_feed_ends_like_a_rebuild(spark, sf_dir, cuts):
    """Batches are cut by document, as settling does, so each sees a document's changes as a whole."""
    i = Inputs(spark, sf_dir)
    (t,) = i.new_tables(i.before)
    for b in range(cuts):
        feeds = []
        for f in i.feeds:
            key = "o_orderkey" if f.table == "orders" else "l_orderkey"
            doc = F.coalesce(F.col(f"new.{key}"), F.col(f"old.{key}"))
            feeds.append(TableFeed(f.table, f.df.where(F.pmod(F.xxhash64(doc), F.lit(cuts)) == b), f.pk))
        sync_batch(spark, i.job([t]), i.after, feeds, batch_id=b, seq=b)
    want = ORDER_DOC.documents(spark, i.after)
    got = t.read()
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    version = t.current().version
    sync_batch(spark, i.job([t]), i.after, i.feeds, batch_id=cuts - 1, seq=0)
    assert t.current().version == version  # a repeated batch is not applied twice


SMALL = DocSource("d", "SELECT t.k AS `id:id`, t.v AS `v:attr_uint`, t.s AS `s:field` FROM {t} t", {"t": "k"}, parts=2)
RULE = IngestRule("t", "k", "d", {"v": ("v",), "s": ("s",)})


def small_feed(spark, *rows):
    """(seq, action, old, new) of table t."""
    image = "struct<k: bigint, v: bigint, s: string>"
    df = spark.createDataFrame(
        [(n, n, None, a, o, w) for n, a, o, w in rows],
        f"seq bigint, event_id bigint, ts timestamp, action string, old {image}, new {image}",
    )
    return [TableFeed("t", df, ("k",))]


def small_job(spark, n=1):
    return SyncJob({"d": SMALL}, [RULE], {"d": [table(spark) for _ in range(n)]})


def base(spark, *rows):
    return {"t": spark.createDataFrame(list(rows), "k bigint, v bigint, s string")}


def test_unchanged_documents_only_move_the_position(spark):
    job, frames = small_job(spark), base(spark, (1, 1, "x"))
    job.check(spark, frames)
    (t,) = job.targets["d"]
    rebuild_group(spark, job, frames, RebuildLog(spark, new_dir(spark, "l")), seq=0)
    same = small_feed(spark, (1, "delete", (1, 1, "x"), None), (2, "insert", None, (1, 1, "x")))
    sync_batch(spark, job, frames, same, batch_id=1, seq=2)
    assert t.current().kind == "position" and t.current().seq == 2
    sync_batch(spark, job, frames, small_feed(spark, (3, "update", (1, 1, "x"), (1, 2, "x"))), batch_id=2, seq=3, advance=False)
    assert t.current().kind == "apply-frozen" and t.current().seq == 2


def test_lagging_replica_catches_up(spark):
    job, frames = small_job(spark, 2), base(spark, (1, 5, "x"))
    a, b = job.targets["d"]
    log = RebuildLog(spark, new_dir(spark, "l"))
    rebuild_group(spark, job, base(spark, (1, 1, "x")), log, seq=0)
    tables = {"a": a, "b": b}
    assert replicas_agree(spark, tables).first()["agree"]
    feed = small_feed(spark, (1, "update", (1, 1, "x"), (1, 5, "x")))
    sync_batch(spark, SyncJob(job.sources, job.rules, {"d": [a]}), frames, feed, batch_id=1, seq=1)
    assert not replicas_agree(spark, tables).first()["agree"]
    assert {r["reason"] for r in recovery_plan(spark, job, frames).collect()} == {"replicas disagree"}
    sync_batch(spark, job, frames, feed, batch_id=1, seq=1)
    assert replicas_agree(spark, tables).first()["agree"]
    assert a.current().version == b.current().version == 2
    done = {r["target"]: r["applied"] for r in applied_up_to(commits(spark, tables), 1).collect()}
    assert done == {"a": True, "b": True}
    assert not applied_up_to(commits(spark, {"a": a}), 2).first()["applied"]
    c = table(spark)
    assert not replicas_agree(spark, {**tables, "c": c}).first()["agree"]  # saved on some targets only
    assert replicas_agree(spark, {"c": c, "d": table(spark)}).first()["agree"]  # saved on none


def test_rebuilds(spark):
    job, frames = small_job(spark), base(spark, (1, 1, "x"))
    (t,) = job.targets["d"]
    log = RebuildLog(spark, new_dir(spark, "l"))
    assert [(r["action"], r["reason"]) for r in recovery_plan(spark, job, frames).collect()] == [("rebuild", "not ready")]
    ticks = iter(range(100))
    clock = lambda: float(next(ticks))
    rebuild_group(spark, job, frames, log, seq=4, build_id="one", clock=clock)
    assert [(r["action"], r["reason"]) for r in recovery_plan(spark, job, frames).collect()] == [("resume", "ready")]
    schema = SMALL.schema(spark, frames)
    assert rebuild_unless(spark, job, frames, log, lambda *_: t.is_ready(schema), seq=5) == {}

    boom = F.udf(lambda v: 1 // 0, "bigint")
    broken = {"t": frames["t"].withColumn("v", boom("v"))}
    with pytest.raises(Exception):
        rebuild_group(spark, job, broken, log, seq=9, build_id="two", clock=clock)
    assert t.current().version == 1 and t.current().seq == 4
    rows = {r["build_id"]: r for r in log.read().collect()}
    assert rows["one"]["success"] and not rows["two"]["success"]
    assert rows["two"]["finished_at"] > rows["two"]["started_at"]

    log.start("three", ["d"], 50.0)
    with pytest.raises(RebuildInProgress):
        rebuild_group(spark, job, frames, log, seq=9, clock=lambda: 60.0)
    rebuild_group(spark, job, frames, log, seq=8, clock=lambda: 60.0, lease=5.0)  # the other one is dead
    assert t.current().seq == 8
    log.finish("three", ["d"], 50.0, True, 51.0)
    rebuild_group(spark, job, frames, log, seq=9, clock=lambda: 60.0)
    assert t.current().seq == 9


def test_rebuild_beside_sync(spark):
    """Batches go on during the build, and changes come that no batch has seen; the replay brings all of them."""
    job, log = small_job(spark), RebuildLog(spark, new_dir(spark, "l"))
    (t,) = job.targets["d"]
    state = {"rows": [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "feed": []}
    frames = lambda: base(spark, *state["rows"])
    feeds = lambda: small_feed(spark, *state["feed"])
    rebuild_group(spark, job, frames(), log, seq=0)
    state["feed"] = [(1, "update", (1, 0, "a"), (1, 1, "a"))]

    def meanwhile():
        old, new = (2, 2, "b"), (2, 9, "b")
        state["rows"] = [(1, 1, "a"), new]
        state["feed"] += [(2, "update", old, new), (3, "delete", (3, 3, "c"), None)]
        frozen = small_feed(spark, state["feed"][1])
        sync_batch(spark, job, frames(), frozen, batch_id=7, stream="live", seq=2, advance=False)
        assert content_of(t)[2] == (9, "b")

    rebuild_and_replay(spark, job, frames, log, feeds, meanwhile=meanwhile)
    assert content_of(t) == {1: (1, "a"), 2: (9, "b")}
    assert t.current().seq == 3
    assert len(t.versions()) == 4


def content_of(t):
    return {r["id"]: (r["v"], r["s"]) for r in t.read().collect()}


def test_recovery_looks_at_each_index(spark):
    """A rebuild of one index sets its position; the other one resumes from its own."""
    second = DocSource("e", SMALL.query, SMALL.tables, parts=2)
    job = SyncJob({"d": SMALL, "e": second}, [RULE], {"d": [table(spark), table(spark)], "e": [table(spark)]})
    frames, log = base(spark, (1, 1, "x")), RebuildLog(spark, new_dir(spark, "l"))

    def plan(**how):
        return {r["index"]: (r["action"], r["reason"]) for r in recovery_plan(spark, job, frames, **how).collect()}

    rebuild_group(spark, job, frames, log, seq=1)
    rebuild_group(spark, job, frames, log, seq=5, indexes=["e"])
    assert plan() == {"d": ("resume", "ready"), "e": ("resume", "ready")}
    job.targets["d"][1].set_position(3)
    assert plan() == {"d": ("rebuild", "replicas disagree"), "e": ("resume", "ready")}
    assert set(recover(spark, job, frames, log, recovery_plan(spark, job, frames), seq=6)) == {"d"}
    assert plan() == {"d": ("resume", "ready"), "e": ("resume", "ready")}
    assert [t.current().seq for ts in job.targets.values() for t in ts] == [6, 6, 5]
    assert plan(force=True) == {"d": ("rebuild", "forced"), "e": ("rebuild", "forced")}


def test_documents_laid_out_once_for_several_tables(spark):
    """Each table takes them by part, without a shuffle of its own; another number of parts is dealt anew."""
    rows = docs(spark, *[(k, k % 5, str(k)) for k in range(200)])
    held = staged_by_part(rows, "id", 4, "held")
    assert held.columns == rows.columns
    changes = decided(spark, *[(k, "replace" if k % 3 else "delete", ["a"], -k, "n") for k in range(0, 200, 2)])
    held_changes = staged_by_part(changes, "doc_id", 4, "changes")
    want = {k: (k % 5, str(k)) if k % 2 else (-k, "n") for k in range(200) if k % 2 or k % 3}
    for parts in (4, 3):
        t = table(spark)
        t.publish(t.build(held if parts == 4 else rows, "id", parts, laid_out=parts == 4))
        t.apply(held_changes, laid_out=4, batch_id=1)
        assert content(t) == want
        for part in range(parts):
            assert set(content(t, parts=[part])) == {k for k in want if k % parts == part}
        assert t.current().n_delete == 34 and t.current().n_replace == 66


def test_newest_write_is_read_without_grouping(spark):
    t = table(spark)
    t.rebuild(docs(spark, *[(k, k, "x") for k in range(20)]), "id", 4)
    want = {k: (k, "x") for k in range(20)}
    for n in range(1, 5):
        rows = [(k, "delete" if k % n == 1 else "replace", ["a"], n, str(n)) for k in range(0, 20 + n, n)]
        t.apply(decided(spark, *rows), batch_id=n)
        for k, action, _, a, x in rows:
            want.pop(k, None)
            if action != "delete":
                want[k] = (a, x)
        assert content(t) == want
        assert content(t, ids=spark.createDataFrame([(k,) for k in range(9)], "doc_id bigint")) == {k: v for k, v in want.items() if k < 9}
        if n < 3:
            assert "max_by" not in t.read()._jdf.queryExecution().optimizedPlan().toString()
    t.merge_deltas()
    assert content(t) == want and len(t.current().delta) == 1


@pytest.mark.parametrize("parts", [4, 9])
def test_many_documents_are_written_where_they_are(spark, parts):
    """With few parts, tasks that hold many documents write them without another shuffle; each part is whole all the same."""
    rows = docs(spark, *[(k, k % 5, str(k)) for k in range(200)]).repartition(3)
    plan = _by_part(rows, "id", parts, many=True)._jdf.queryExecution().executedPlan().toString()
    assert ("REBALANCE" in plan) is (parts > 4)
    assert "REBALANCE" in _by_part(rows, "id", parts)._jdf.queryExecution().executedPlan().toString()
    t = table(spark)
    t.rebuild(rows, "id", parts)
    changes = decided(spark, *[(k, "replace" if k % 3 else "delete", ["a"], -k, "n") for k in range(0, 200, 2)])
    t.apply(changes.repartition(3), batch_id=1, many=True)
    want = {k: (k % 5, str(k)) if k % 2 else (-k, "n") for k in range(200) if k % 2 or k % 3}
    assert content(t) == want
    for part in range(parts):
        assert set(content(t, parts=[part])) == {k for k in want if k % parts == part}


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_only_rows_that_may_stay_are_shuffled(spark, limit):
    """Many ids cut down stored rows where they are read: by the ids' bits, or by those of the keys that no id replaces."""
    rows = [(k, k % 5, str(k)) for k in range(300)]
    t = table(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        t.rebuild(docs(spark, *rows), "id", 4)
        ids = staged(spark.createDataFrame([(k,) for k in [*range(0, 300, 50), 50, 999, None]], "doc_id bigint"), "ids")
        assert content(t, ids=ids) == {k: (k % 5, str(k)) for k in range(0, 300, 50)}
        plan = t.read(ids=ids)._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("LeftSemi") == 2 and "_bits" in plan) is (limit == "-1")

        changes = [(k, "replace" if k % 3 else "delete", ["a"], -k, "n") for k in range(300) if k % 10]
        t.apply(decided(spark, *changes), batch_id=1)
        want = {k: (k % 5, str(k)) if k % 10 == 0 else (-k, "n") for k in range(300) if k % 10 == 0 or k % 3}
        assert content(t) == want and t.read().count() == len(want)
        plan = t.read()._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("LeftAnti") == 2 and "_bits" in plan) is (limit == "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
