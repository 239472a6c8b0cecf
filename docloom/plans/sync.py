"""One sync batch: from settled row changes to applied documents on every target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.decide import decide
from docloom.operators.netchange import changed_attrs
from docloom.operators.rules import IngestRule, RoutedChanges, TableFeed, check_rules, route
from docloom.operators.source import DocSource
from docloom.plans.target import DocTable, Version, staged_by_part
from docloom.session import staged, unstage

#: A batch of so many documents is written from the tasks that hold them, if the table has few parts.
MANY_DOCS = 100_000


@dataclass(frozen=True)
class SyncJob:
    """Document sources by index, the rules that feed them, and the replicas each index is written to."""

    sources: Mapping[str, DocSource]
    rules: Sequence[IngestRule]
    targets: Mapping[str, Sequence[DocTable]]

    def check(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
        columns = {name: list(s.types(spark, frames)) for name, s in self.sources.items()}
        check_rules(self.rules, self.sources, columns)


def decided_documents(
    spark: SparkSession, source: DocSource, frames: Mapping[str, DataFrame], changed: DataFrame
) -> DataFrame:
    """Re-read the changed documents through their query and decide what to do with each."""
    docs = source.single(spark, frames, source.documents(spark, frames, ids=changed))
    return decide(
        changed, docs, source.id_column(spark, frames), source.in_place_columns(spark, frames), source.parts
    )


def sync_routed(
    spark: SparkSession,
    job: SyncJob,
    frames: Mapping[str, DataFrame],
    routed: Sequence[RoutedChanges],
    *,
    batch_id: int,
    seq: int | None,
    stream: str = "",
    event_id: int | None = None,
    ts: float | None = None,
    upsert_missing: bool = True,
    advance: bool = True,
    replay: bool = False,
    within: DataFrame | None = None,
) -> dict[str, list[Version]]:
    """Apply routed changes as batch `batch_id`, or those of them that belong to the queue's batches `within`.

    Changed ids are written out first: the re-read joins them with several base tables, and the written table's
    size is what decides whether they are broadcast.  Decided documents that several replicas take are written once, by
    part, and applied to each of them from there without another shuffle.  Replicas that already hold the batch of this stream are left alone, so a failed batch can be
    repeated; another stream (a new checkpoint, a replay) starts its own count.  A `replay` closes what a rebuild left
    open.
    """
    done: dict[str, list[Version]] = {}
    for index, source in job.sources.items():
        behind = [t for t in job.targets[index] if not _has_batch(t, stream, batch_id)]
        mine = [r for r in routed if r.index == index]
        if not behind:
            continue
        changed = staged(changed_attrs(mine, within).select("doc_id", "attrs"), "changed") if mine else None
        n_changed = 0 if changed is None else changed.count()  # from the written files' footers
        if not n_changed:
            done[index] = [
                t.set_position(seq, event_id, batch_id=batch_id, stream=stream, ts=ts, advance=advance, replay=replay)
                for t in behind
            ]
            unstage(changed)
            continue
        decided = decided_documents(spark, source, frames, changed)
        written, parts, many = None, None, n_changed >= MANY_DOCS
        if len(behind) > 1 and upsert_missing:
            parts = source.parts
            written = decided = staged_by_part(decided, "doc_id", parts, "decided", many)
        elif len(behind) > 1 or not upsert_missing:
            # updates of named attributes read them more than once
            written = decided = staged(decided, "decided")
        done[index] = [
            t.apply(
                decided, batch_id=batch_id, stream=stream, seq=seq, event_id=event_id, ts=ts,
                upsert_missing=upsert_missing, advance=advance, replay=replay, laid_out=parts, many=many,
            )
            for t in behind
        ]
        unstage(changed, written)
    return done


def sync_batch(
    spark: SparkSession, job: SyncJob, frames: Mapping[str, DataFrame], feeds: Sequence[TableFeed], **options
) -> dict[str, list[Version]]:
    """Route a batch of feeds and apply it."""
    return sync_routed(spark, job, frames, route(feeds, job.rules), **options)


def _has_batch(table: DocTable, stream: str, batch_id: int) -> bool:
    v = table.current()
    return v is not None and v.has_batch(stream, batch_id)


def sync_counters(routed: Sequence[RoutedChanges], events: Mapping[str, DataFrame], decided: DataFrame) -> DataFrame:
    """Counters of one batch: row events read, document changes routed, documents per action."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(f"row_events:{t}").alias("counter"), "n")
        for t, df in events.items()
    ]
    counts += [
        r.df.agg(F.count("*").alias("n")).select(F.lit(f"doc_events:{r.table}").alias("counter"), "n")
        for r in routed
    ]
    counts.append(
        decided.groupBy("action").agg(F.count("*").alias("n")).select(
            F.concat(F.lit("docs:"), "action").alias("counter"), "n"
        )
    )
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out
