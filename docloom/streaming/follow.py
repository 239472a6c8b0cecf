"""Follow a change feed: queue what arrives, and at every trigger sync the documents that have settled.

The queue is a small table with one row per waiting document, written once per micro-batch before anything is
applied.  A micro-batch that is repeated after a failure finds its own queue table and applies the same documents.
Row changes are read again from the feed by document and position range; they are never collected.

Which files hold which positions is noted as they arrive and carried from batch to batch as long as a change in them
waits, so a micro-batch lists no folder and opens only the files of its range.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.pending import doc_batches, merge_batches, settle_split
from docloom.operators.positions import resume_after
from docloom.operators.rules import TableFeed, route, touched_by
from docloom.plans.maintenance import compact_if_needed
from docloom.plans.sync import SyncJob, sync_routed
from docloom.sources.feed import read_feed, stream_feed

QUEUE = (
    "index string, doc_id bigint, first_ts timestamp, last_ts timestamp, n_rows bigint, first_event_id bigint, "
    "first_seq bigint, last_seq bigint, ready boolean"
)
SEEN = "table string, seq bigint, event_id bigint"
FILES = "table string, file string, lo bigint, hi bigint"
METRICS = (
    "batch_id bigint, at double, arrived bigint, ready bigint, waiting bigint, seq bigint, counters map<string, bigint>"
)
COUNTS = "counter string, n bigint"


class Stopping(RuntimeError):
    """Raised in a micro-batch that begins while the follower is being stopped; it is done again after a restart."""


@dataclass
class Follower:
    """Keeps the targets of `job` in step with the feed under `feed_root`.

    `frames` returns the base tables as they are now: documents are re-read from the present, not from the time
    of the change.  `tables` maps feed tables to their primary key columns.

    The recorded position is one before which everything is applied: the least, over the tables with rules and the
    waiting changes, of what has been seen.  A table is seen up to its last change, or up to `high_water()[table]` where
    the source knows that it has delivered more than there are changes; without that, a quiet table holds the position.

    `start_after` is the position of a new follower: it takes no change at or before it, and tables count as seen up to
    it.  A follower with a state folder goes on from there instead.
    """

    spark: SparkSession
    job: SyncJob
    frames: Callable[[], Mapping[str, DataFrame]]
    feed_root: str
    tables: Mapping[str, Sequence[str]]
    state_dir: str
    gap_seconds: float = 1.0
    hold_seconds: float = 10.0
    clock: Callable[[], float] = time.time
    upsert_missing: bool = True
    build_mode: bool = False
    high_water: Callable[[], Mapping[str, int]] = dict
    start_after: int | None = None
    upkeep_every: int = 50  # micro-batches between two rounds of upkeep; 0 leaves it to the caller
    max_delta_bytes: int = 256 << 20
    keep_versions: int = 100
    last: dict = field(default_factory=dict)
    _schemas: dict = field(default_factory=dict, repr=False)
    _busy: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _stopping: bool = False

    def arrivals(self, heartbeat: bool = False, **options) -> DataFrame:
        """Stream of routed changes, narrowed to what the queue needs.

        With `heartbeat`, one empty row per second keeps triggers firing while the feed is quiet.
        """
        feeds = [
            stream_feed(self.spark, self.feed_root, f.table, f.df.schema, f.pk, **options) for f in self._stored()
        ]
        if self.start_after is not None:
            feeds = [TableFeed(f.table, resume_after(f.df, self.start_after), f.pk) for f in feeds]
        rows = touched_by(feeds, self.job.rules).select(
            "index", "table", "action", "event_action", "doc_id", "seq", "event_id", "lead", F.input_file_name().alias("file")
        )
        if heartbeat:
            beat = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            none = [F.lit(None).cast(t).alias(c) for c, t in rows.dtypes]
            rows = rows.unionByName(beat.select(*none))
        return rows

    def start(self, heartbeat: bool = True, trigger: Mapping | None = None, **options):
        """Check the rules and start the streaming query; its checkpoint lives beside the queue."""
        self.job.check(self.spark, self.frames())
        return (
            self.arrivals(heartbeat, **options)
            .writeStream.foreachBatch(self.on_batch)
            .option("checkpointLocation", f"{self.state_dir}/checkpoint")
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start()
        )

    def stop(self, query) -> None:
        """Stop between two micro-batches instead of interrupting one."""
        with self._busy:
            self._stopping = True
        query.stop()

    def _stored(self) -> list[TableFeed]:
        feeds = read_feed(self.spark, self.feed_root, self.tables, self._schemas)
        self._schemas = {f.table: f.df.schema for f in feeds}
        return feeds

    # one micro-batch ------------------------------------------------------------------------------------------

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _saved(self, name: str, batch_id: int, schema: str) -> DataFrame | None:
        path = f"{self.state_dir}/{name}/b={batch_id}"
        if not self._exists(f"{path}/_SUCCESS"):
            return None
        return self.spark.read.schema(schema).parquet(path)

    def stream(self) -> str:
        """Name of this state folder's count of batches, given once."""
        path = f"{self.state_dir}/stream"
        if not self._exists(f"{path}/_SUCCESS"):
            name = self.spark.createDataFrame([(uuid.uuid4().hex,)], "stream string")
            name.coalesce(1).write.mode("overwrite").parquet(path)
        return self.spark.read.schema("stream string").parquet(path).first()["stream"]

    def _queue(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """This batch's queue with its `ready` flags, made once."""
        done = self._saved("queue", batch_id, QUEUE)
        if done is not None and self._saved("seen", batch_id, SEEN) is not None:
            return done
        waiting, before = self._saved("queue", batch_id - 1, QUEUE), self._saved("seen", batch_id - 1, SEEN)
        if batch_id > 0 and (waiting is None or before is None):
            raise RuntimeError(f"{self.state_dir} lacks the queue of batch {batch_id - 1}; documents that wait would be lost")
        arrived = F.timestamp_micros(F.lit(int(self.clock() * 1e6)))
        rows = rows.persist()
        fresh = rows.where(F.col("doc_id").isNotNull()).withColumn("ts", arrived)
        try:
            parts = [doc_batches(fresh)]
            top = fresh.select("table", "seq", "event_id")
            if waiting is not None:
                parts.append(waiting.where(~F.col("ready")).drop("ready"))
                top = top.unionByName(before)
            merged = merge_batches(reduce(DataFrame.unionByName, parts))
            split = settle_split(merged, arrived, self.gap_seconds, self.hold_seconds)
            split.write.mode("overwrite").parquet(f"{self.state_dir}/queue/b={batch_id}")
            self._note_files(fresh, batch_id)
            self._count_rows(rows, batch_id)
            seen = top.groupBy("table").agg(F.max("seq").alias("seq"), F.max("event_id").alias("event_id"))
            seen.coalesce(1).write.mode("overwrite").parquet(f"{self.state_dir}/seen/b={batch_id}")
            self.last = {"arrived": fresh.count()}
        finally:
            rows.unpersist()
        return self._saved("queue", batch_id, QUEUE)

    def _note_files(self, fresh: DataFrame, batch_id: int) -> None:
        """The files of this batch, and those before that a change in the queue may be in.  Rows that don't say which file
        they come from leave no note, and then the whole feed is read."""
        before = self._saved("files", batch_id - 1, FILES)
        if "file" not in fresh.columns or (batch_id > 0 and before is None):
            return
        files = fresh.groupBy("table", "file").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
        if before is not None:
            oldest = self._saved("queue", batch_id, QUEUE).agg(F.min("first_seq")).first()[0]
            files = files.unionByName(before.where(F.lit(False) if oldest is None else F.col("hi") >= oldest))
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.state_dir}/files/b={batch_id}")

    def _count_rows(self, rows: DataFrame, batch_id: int) -> None:
        """Row changes and document changes of each table and action, counted where they arrive."""
        if not {"action", "event_action", "lead"} <= set(rows.columns):
            return
        names = F.array(
            F.when(F.col("lead"), F.concat_ws(":", F.lit("row_events"), "table", "event_action")),
            F.concat_ws(":", F.lit("doc_events"), "table", "action"),
        )
        named = rows.where(F.col("table").isNotNull()).select(F.explode(F.array_compact(names)).alias("counter"))
        counts = named.groupBy("counter").agg(F.count(F.lit(1)).alias("n"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.state_dir}/counts/b={batch_id}")

    def _changes(self, batch_id: int, lo: int, hi: int) -> list[TableFeed]:
        """The feeds between two positions, from the files that hold them."""
        noted = self._saved("files", batch_id, FILES)
        if noted is None:
            found = self._stored()
        else:
            paths: dict[str, set[str]] = {}
            # a row for each file of the range
            for r in noted.where((F.col("hi") >= lo) & (F.col("lo") <= hi)).collect():
                paths.setdefault(r["table"], set()).add(unquote(r["file"]))
            known = self._known()
            found = [
                TableFeed(t, self.spark.read.schema(known[t]).parquet(*sorted(paths[t])), tuple(pk))
                for t, pk in self.tables.items()
                if t in paths
            ]
        return [TableFeed(f.table, f.df.where(F.col("seq").between(lo, hi)), f.pk) for f in found]

    def _known(self) -> Mapping:
        """Schemas of the feed tables, looked up once."""
        if not self._schemas:
            self._stored()
        return self._schemas

    def _frontier(self, batch_id: int) -> tuple[int | None, int | None]:
        """(seq, event_id) up to which every table with a rule has been seen."""
        seen = {r["table"]: (r["seq"], r["event_id"]) for r in self._saved("seen", batch_id, SEEN).collect()}
        known = self.high_water()
        needed = {r.table for r in self.job.rules} & set(self.tables)
        ends = []
        for t in needed:
            seq, event = seen.get(t, (None, None))
            if seq is None:
                seq = self.start_after
            if t in known and (seq is None or known[t] > seq):
                seq, event = known[t], None
            ends.append((seq, event))
        if not ends or any(seq is None for seq, _ in ends):
            return None, None
        seq = min(s for s, _ in ends)
        events = [e for _, e in seen.values() if e is not None]
        at = [e for s, e in ends if s == seq and e is not None]
        return seq, at[0] if at else max(events, default=None)

    def on_batch(self, rows: DataFrame, batch_id: int) -> None:
        with self._busy:
            if self._stopping:
                raise Stopping(f"batch {batch_id} is left for the next start")
            self._sync(rows, batch_id)

    def _sync(self, rows: DataFrame, batch_id: int) -> None:
        queue = self._queue(rows, batch_id)
        seen_seq, seen_event = self._frontier(batch_id)
        w, r = ~F.col("ready"), F.col("ready")
        sums = queue.agg(
            F.min(F.when(w, F.col("first_seq"))).alias("wait_seq"),
            F.min(F.when(w, F.col("first_event_id"))).alias("wait_event"),
            F.min(F.when(r, F.col("first_seq"))).alias("lo"),
            F.max(F.when(r, F.col("last_seq"))).alias("hi"),
            F.count_if(r).alias("n_ready"),
            F.count_if(w).alias("n_waiting"),
        ).first()
        # everything before the oldest waiting change, and before what some table has not delivered, is applied
        seq, event_id = seen_seq, seen_event
        if sums["n_waiting"] and (seq is None or sums["wait_seq"] - 1 <= seq):
            seq = None if seen_seq is None else sums["wait_seq"] - 1
            event_id = None if seen_seq is None else sums["wait_event"]
        applied: Mapping[str, Sequence] = {}
        how = {"batch_id": batch_id, "stream": self.stream(), "ts": self.clock()}
        if sums["n_ready"]:
            feeds = self._changes(batch_id, sums["lo"], sums["hi"])
            routed = route(feeds, self.job.rules)
            applied = sync_routed(
                self.spark, self.job, self.frames(), routed,
                seq=seq,
                event_id=event_id,
                upsert_missing=self.upsert_missing,
                advance=not self.build_mode and seq is not None,
                within=queue.where(r),
                **how,
            )
        elif seq is not None and not self.build_mode:
            # nothing to apply, but the position may have moved on
            for table in (t for ts in self.job.targets.values() for t in ts):
                v = table.current()
                if v is not None and (v.seq is None or v.seq < seq):
                    table.set_position(seq, event_id, **how)
        self._count(batch_id, sums, seq, applied, how["stream"])
        self._forget(batch_id - 2)
        if self.upkeep_every and batch_id % self.upkeep_every == self.upkeep_every - 1:
            for table in (t for ts in self.job.targets.values() for t in ts):
                compact_if_needed(table, self.max_delta_bytes)
                table.trim_history(self.keep_versions)

    def _count(self, batch_id: int, sums, seq: int | None, applied: Mapping[str, Sequence], stream: str) -> None:
        """Counters of the batch, kept as a table: one row for each batch, replaced if it is repeated."""
        held = self._saved("counts", batch_id, COUNTS)
        counters = {r["counter"]: r["n"] for r in held.collect()} if held is not None else {}  # a row for each table and action
        for index, targets in self.job.targets.items():
            # replicas get the same documents, and one that had the batch before has its numbers in its own version
            now = applied.get(index) or [t.current() for t in targets]
            v = next((v for v in now if v is not None and (v.stream, v.batch_id) == (stream, batch_id)), None)
            for action, n in () if v is None else (("replace", v.n_replace), ("update", v.n_update), ("delete", v.n_delete)):
                if n:
                    counters[f"docs:{index}:{action}"] = n
        self.last = {"batch_id": batch_id, **self.last, "ready": sums["n_ready"], "waiting": sums["n_waiting"]}
        row = (batch_id, self.clock(), self.last.get("arrived"), sums["n_ready"], sums["n_waiting"], seq, counters)
        frame = self.spark.createDataFrame([row], METRICS)
        folders = self._metric_folders()
        fold = self.upkeep_every and batch_id % self.upkeep_every == self.upkeep_every - 1
        others = [n for n in folders if n != f"b={batch_id}"]
        if fold and others:
            # one folder in place of many; what dies before the others are removed leaves rows twice, which are read once
            held = self.spark.read.schema(METRICS).parquet(*(f"{self.state_dir}/metrics/{n}" for n in others))
            frame = frame.unionByName(held.dropDuplicates(["batch_id"]).where(F.col("batch_id") != batch_id))
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.state_dir}/metrics/b={batch_id}")
        for n in others if fold else ():
            self._delete(f"{self.state_dir}/metrics/{n}")

    def _metric_folders(self) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.state_dir}/metrics")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def metrics(self) -> DataFrame:
        """Counters of all batches."""
        return self.spark.read.schema(METRICS).parquet(f"{self.state_dir}/metrics").dropDuplicates(["batch_id"])

    def counters(self) -> DataFrame:
        """(counter, n): row changes read and document changes by table and action, documents applied by index and action,
        summed over all batches, from the stored counters alone."""
        return self.metrics().select(F.explode("counters").alias("counter", "n")).groupBy("counter").agg(F.sum("n").alias("n"))

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def _forget(self, batch_id: int) -> None:
        for name in ("queue", "seen", "files", "counts"):
            self._delete(f"{self.state_dir}/{name}/b={batch_id}")
