"""Writers that meet: what was reported as published is there, or its writer was told that it isn't."""

import os
import threading

import pytest

from docloom.plans import once, rebuild
from docloom.plans.commits import commits
from docloom.plans.once import ConditionalStore, LinkStore, RenameStore, put_once, register
from docloom.plans.rebuild import RebuildLog, rebuild_and_replay, rebuild_group, replay
from docloom.plans.recovery import recover, recovery_plan
from docloom.plans.target import DocTable, WriteConflict
from docloom.session import new_dir

from test_target import base, content, content_of, decided, docs, small_feed, small_job, table


def put(t, key, batch_id, stream):
    return t.apply(decided(t.spark, (key, "replace", ["t"], key, stream)), batch_id=batch_id, stream=stream, seq=batch_id)


@pytest.fixture
def started(spark):
    t = table(spark)
    t.rebuild(docs(spark, (1, 1, "x"), (2, 2, "y")), "id", 4, seq=0)
    return t, DocTable(spark, t.root)


def test_another_writer_between_filling_and_creating(started, monkeypatch):
    """The first writer's file is filled when the second publishes under the same number."""
    a, b = started
    link, met = os.link, []

    def late(filled, target):
        if not met:
            met.append(open(filled).read())
            put(b, 3, 1, "b")
        link(filled, target)

    monkeypatch.setattr(once.os, "link", late)
    with pytest.raises(WriteConflict):
        put(a, 1, 1, "a")
    assert met[0].startswith("{") and content(a) == {1: (1, "x"), 2: (2, "y"), 3: (3, "b")}
    put(a, 1, 1, "a")  # its writer was told, and does it again
    assert content(b) == {1: (1, "a"), 2: (2, "y"), 3: (3, "b")}
    assert [n for n in os.listdir(f"{a.root}/versions".removeprefix("file:")) if n.startswith(".")] == []


def test_another_writer_between_looking_and_numbering(started, monkeypatch):
    """What is published after the current version was read takes the number that was meant for the next one."""
    a, b = started
    look, met = a.current, []

    def early(version=None):
        found = look(version)
        if found and len(met) == 1:
            put(b, 3, 1, "b")
        met.append(found)
        return found

    monkeypatch.setattr(a, "current", early)  # the first look is that of `apply`, the second that of publishing
    with pytest.raises(WriteConflict):
        put(a, 1, 1, "a")
    monkeypatch.undo()
    assert content(a) == {1: (1, "x"), 2: (2, "y"), 3: (3, "b")}
    assert [v for v in a.versions()] == [1, 2]


def test_many_writers_at_once(started):
    """Each either publishes or fails; all that published is in the table."""
    a, _ = started
    done, failed = [], []

    def write(key):
        try:
            put(DocTable(a.spark, a.root), key, 1, f"w{key}")
            done.append(key)
        except WriteConflict:
            failed.append(key)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(10, 16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) + len(failed) == 6 and done
    assert set(content(a)) == {1, 2, *done}
    assert len(a.versions()) == 1 + len(done)


@pytest.mark.parametrize("store", [LinkStore(), RenameStore()])
def test_once(spark, tmp_path, store):
    path = f"file:{tmp_path}/a folder/1.json"
    if isinstance(store, RenameStore):
        (tmp_path / "a folder").mkdir()
    assert store.put(spark, path, b"first")
    assert not store.put(spark, path, b"second")
    assert (tmp_path / "a folder" / "1.json").read_bytes() == b"first"
    assert [p.name for p in (tmp_path / "a folder").iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_stores_by_scheme(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(once, "_stores", {})
    with pytest.raises(NotImplementedError):
        put_once(spark, f"file:{tmp_path}/x", b"1")
    register("file", LinkStore())
    assert put_once(spark, f"file:{tmp_path}/x", b"1") and not put_once(spark, f"{tmp_path}/x", b"2")
    with pytest.raises(Exception):  # a local file system knows no conditional creation, and says so
        ConditionalStore().put(spark, f"file:{tmp_path}/y", b"1")
    assert not (tmp_path / "y").exists()


def test_a_replay_meets_a_follower(spark, monkeypatch):
    """A follower publishes while the replay is being written; the replay is done again, and the position, which
    the follower may not move, ends at what was replayed."""
    job, log = small_job(spark), RebuildLog(spark, new_dir(spark, "l"))
    (t,) = job.targets["d"]
    rows = [(1, 1, "a"), (2, 2, "b")]
    state = {"rows": rows, "feed": [(1, "insert", None, rows[0])]}
    frames = lambda: base(spark, *state["rows"])
    feeds = lambda: small_feed(spark, *state["feed"])
    rebuild_group(spark, job, frames(), log, seq=0)
    write, met = DocTable._write, []

    def meanwhile():
        state["rows"] = [(1, 1, "a"), (2, 9, "b")]
        state["feed"] += [(2, "update", (2, 2, "b"), (2, 9, "b"))]

    def late(self, documents, id_column, parts, kind, version):
        out = write(self, documents, id_column, parts, kind, version)
        if kind == "delta" and not met:
            met.append(1)
            state["rows"] = [*state["rows"], (5, 5, "e")]
            state["feed"] += [(50, "insert", None, (5, 5, "e"))]
            live = small_feed(spark, state["feed"][-1])
            met.append(rebuild.sync_batch(spark, job, frames(), live, batch_id=3, stream="live", seq=50)["d"][0])
        return out

    monkeypatch.setattr(DocTable, "_write", late)
    rebuild_and_replay(spark, job, frames, log, feeds, meanwhile=meanwhile)
    assert met[1].kind == "apply-frozen" and met[1].seq == 1 and met[1].replaying
    assert content_of(t) == {1: (1, "a"), 2: (9, "b"), 5: (5, "e")}
    assert t.current().seq == 50 and not t.current().replaying
    assert [r["seq"] for r in commits(spark, {"t": t}).orderBy("version").collect()] == [0, 1, 1, 50]


def test_a_replay_that_died_is_found(spark, monkeypatch):
    job, log = small_job(spark), RebuildLog(spark, new_dir(spark, "l"))
    (t,) = job.targets["d"]
    frames = lambda: base(spark, (1, 1, "a"))
    feeds = lambda: small_feed(spark, (1, "insert", None, (1, 1, "a")))

    def dies(*_, **__):
        raise MemoryError

    with monkeypatch.context() as m:
        m.setattr(rebuild, "sync_batch", dies)
        with pytest.raises(MemoryError):
            rebuild_and_replay(spark, job, frames, log, feeds)
    plan = recovery_plan(spark, job, frames())
    assert [(r["action"], r["reason"]) for r in plan.collect()] == [("rebuild", "replay is open")]
    t.set_position(9, stream="live", batch_id=1)
    t.compact([0])
    assert t.current().seq == 1 and t.current().replaying
    replay(spark, job, frames, feeds, t.current().seq, indexes=["d"])  # either finishes it
    assert [r["action"] for r in recovery_plan(spark, job, frames()).collect()] == ["resume"]
    recover(spark, job, frames(), log, plan, seq=1)  # or rebuilds
    assert not t.current().replaying and content_of(t) == {1: (1, "a")}
