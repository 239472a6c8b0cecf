"""Full rebuilds: several indexes under one build id, published together, resumed from the position before them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.positions import resume_after
from docloom.operators.rules import TableFeed
from docloom.operators.source import DocSource
from docloom.plans.sync import SyncJob, sync_batch
from docloom.plans.target import DocTable, Version, WriteConflict, staged_by_part
from docloom.session import unstage

LOG = "build_id string, indexes array<string>, started_at double, finished_at double, success boolean"
#: Seconds after which a rebuild that was begun and neither finished nor failed counts as dead.
LEASE = 24 * 3600.0


class RebuildInProgress(RuntimeError):
    """Another rebuild of one of the indexes has started and not finished."""


class RebuildLog:
    """Append-only record of rebuilds; the latest record of a build id counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/rebuild_log"

    def _append(self, *row) -> None:
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, build_id: str, indexes: Sequence[str], at: float) -> None:
        self._append(build_id, list(indexes), at, None, None)

    def finish(self, build_id: str, indexes: Sequence[str], started_at: float, success: bool, at: float) -> None:
        self._append(build_id, list(indexes), started_at, at, success)

    def read(self) -> DataFrame:
        """One row per build."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            rows = self.spark.read.schema(LOG).parquet(self.path)
        else:
            rows = self.spark.createDataFrame([], LOG)
        last = F.max_by(F.struct("indexes", "started_at", "finished_at", "success"), F.coalesce("finished_at", F.lit(-1.0)))
        return rows.groupBy("build_id").agg(last.alias("r")).select("build_id", "r.*")

    def running(self, since: float = float("-inf"), before: tuple[float, str] | None = None) -> set[str]:
        """Indexes with an unfinished rebuild that began at `since` or later; with `before`, only rebuilds that come
        before this (start, build id)."""
        rows = self.read().where(F.col("finished_at").isNull() & (F.col("started_at") >= F.lit(since)))
        if before is not None:
            rows = rows.where(F.struct("started_at", "build_id") < F.struct(F.lit(before[0]), F.lit(before[1])))
        return {r["i"] for r in rows.select(F.explode("indexes").alias("i")).distinct().collect()}


def rebuild_group(
    spark: SparkSession,
    job: SyncJob,
    frames: Mapping[str, DataFrame],
    log: RebuildLog,
    *,
    seq: int | None,
    event_id: int | None = None,
    indexes: Sequence[str] | None = None,
    build_id: str | None = None,
    clock: Callable[[], float] = time.time,
    lease: float = LEASE,
    replaying: bool = False,
    before_swap: Callable[[], None] = lambda: None,
) -> dict[str, list[Version]]:
    """Rebuild the indexes (default: all) on all their targets.

    `seq` is the feed position taken before the build began; rebuilt targets resume from there, so changes made
    meanwhile are applied again.  Nothing is published unless every index was written on every target.

    The log's start record is the claim.  It is written first and looked at afterwards, so of two rebuilds that start
    together the later one gives way.  A claim older than `lease` seconds is that of a dead job.
    """
    indexes = list(job.sources) if indexes is None else list(indexes)
    build_id = build_id or uuid.uuid4().hex
    started = clock()
    log.start(build_id, indexes, started)
    ok = False
    try:
        busy = log.running(started - lease, before=(started, build_id)) & set(indexes)
        if busy:
            raise RebuildInProgress(f"already being rebuilt: {sorted(busy)}")
        built: list[tuple[str, DocTable, Version]] = []
        for index in indexes:
            source, tables = job.sources[index], job.targets[index]
            docs = source.single(spark, frames, source.documents(spark, frames))
            several = len(tables) > 1
            key = source.id_column(spark, frames)
            docs = staged_by_part(docs, key, source.parts, "rebuild", many=True) if several else docs
            for table in tables:
                v = table.build(
                    docs, key, source.parts,
                    seq=seq, event_id=event_id, build_id=build_id, ts=started, replaying=replaying, laid_out=several,
                )
                built.append((index, table, v))
            unstage(docs if several else None)
        before_swap()
        out: dict[str, list[Version]] = {}
        for index, table, v in built:
            out.setdefault(index, []).append(table.publish(v))
        ok = True
        return out
    finally:
        log.finish(build_id, indexes, started, ok, clock())


def rebuild_and_replay(
    spark: SparkSession,
    job: SyncJob,
    frames: Callable[[], Mapping[str, DataFrame]],
    log: RebuildLog,
    feeds: Callable[[], Sequence[TableFeed]],
    *,
    meanwhile: Callable[[], None] = lambda: None,
    indexes: Sequence[str] | None = None,
    **options,
) -> dict[str, list[Version]]:
    """Rebuild while changes go on, then apply again what came after the position taken at the start.

    `frames` and `feeds` are asked twice, before the build and after the swap.  Batches applied during the build
    (`meanwhile` is where a caller may run them) are superseded by the swap, which sets the position back; the replay
    brings them and what else the build may have missed.  A follower may go on between swap and replay: its batches are
    applied, but the position stays until the replay is.
    """
    indexes = list(job.sources) if indexes is None else list(indexes)
    seq, event_id = feed_end(feeds())
    rebuild_group(
        spark, job, frames(), log,
        seq=seq, event_id=event_id, indexes=indexes, before_swap=meanwhile, replaying=True, **options,
    )
    return replay(spark, job, frames, feeds, seq, indexes=indexes)


def replay(
    spark: SparkSession,
    job: SyncJob,
    frames: Callable[[], Mapping[str, DataFrame]],
    feeds: Callable[[], Sequence[TableFeed]],
    seq: int | None,
    *,
    indexes: Sequence[str],
) -> dict[str, list[Version]]:
    """Apply again what came after position `seq`, and let the tables' positions move on from there.

    Another writer may publish in between; then feeds and base tables are looked at again.  Until this succeeds, the
    tables hold the rebuild's position, so a job that dies here leaves what `recovery_plan` finds.
    """
    mine = SyncJob({i: job.sources[i] for i in indexes}, [r for r in job.rules if r.index in indexes], job.targets)
    stream = f"replay-{uuid.uuid4().hex}"
    while True:
        now = feeds()
        later = [TableFeed(f.table, resume_after(f.df, seq), f.pk) for f in now]
        end, end_event = feed_end(later)
        if end is None:
            later, (end, end_event) = [], feed_end(now)
        try:
            return sync_batch(
                spark, mine, frames(), later, batch_id=0, stream=stream, seq=end, event_id=end_event, replay=True
            )
        except WriteConflict:
            continue


def feed_end(feeds: Sequence[TableFeed]) -> tuple[int | None, int | None]:
    """Last position of the feeds."""
    rows = reduce(DataFrame.unionByName, [f.df.select("seq", "event_id") for f in feeds])
    return tuple(rows.agg(F.max("seq"), F.max("event_id")).first())


def rebuild_unless(
    spark: SparkSession,
    job: SyncJob,
    frames: Mapping[str, DataFrame],
    log: RebuildLog,
    is_fine: Callable[[str, DocSource], bool],
    **options,
) -> dict[str, list[Version]]:
    """Rebuild the indexes for which `is_fine` is false."""
    indexes = [i for i, s in job.sources.items() if not is_fine(i, s)]
    return rebuild_group(spark, job, frames, log, indexes=indexes, **options) if indexes else {}
