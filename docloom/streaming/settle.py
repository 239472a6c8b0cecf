"""The settle window as a stateful streaming operator.

State per document is one small record, whatever the number of its changes: the changes themselves stay in the
feed, and a settled document names their range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = (
    "first_ms bigint, last_ms bigint, due_ms bigint, n_rows bigint, first_event_id bigint, first_seq bigint, last_seq bigint"
)
SETTLED = (
    "index string, doc_id bigint, first_ms bigint, last_ms bigint, n_rows bigint, first_event_id bigint, "
    "first_seq bigint, last_seq bigint"
)
_PARTIAL = "index string, doc_id bigint, n_rows bigint, first_event_id bigint, first_seq bigint, last_seq bigint"


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per document and Arrow batch, so a hot document crosses the shuffle as a few rows."""
    for frame in frames:
        if len(frame):
            yield frame.groupby(["index", "doc_id"], as_index=False, sort=False).agg(
                n_rows=("seq", "size"), first_event_id=("event_id", "min"), first_seq=("seq", "min"),
                last_seq=("seq", "max"),
            )


class SettleProcessor(StatefulProcessor):
    """Holds a document until it was quiet for `gap_ms` or has waited for `hold_ms`."""

    def __init__(self, gap_ms: int, hold_ms: int):
        self.gap_ms = gap_ms
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        old = self.pending.get() if self.pending.exists() else None
        first, n, event, lo, hi = (old[0], old[3], old[4], old[5], old[6]) if old else (now, 0, None, None, None)
        for frame in rows:
            n += int(frame["n_rows"].sum())
            event = _least(event, int(frame["first_event_id"].min()))
            lo = _least(lo, int(frame["first_seq"].min()))
            hi = int(frame["last_seq"].max()) if hi is None else max(hi, int(frame["last_seq"].max()))
        if old:
            self.handle.deleteTimer(old[2])
        due = min(now + self.gap_ms, first + self.hold_ms)
        if due <= now:
            self.pending.clear()
            yield self._settled(key, (first, now, due, n, event, lo, hi))
        else:
            self.pending.update((first, now, due, n, event, lo, hi))
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.pending.exists():
            state = self.pending.get()
            self.pending.clear()
            yield self._settled(key, state)

    def _settled(self, key, state) -> pd.DataFrame:
        first, last, _, n, event, lo, hi = state
        return pd.DataFrame(
            [(key[0], key[1], first, last, n, event, lo, hi)],
            columns=["index", "doc_id", "first_ms", "last_ms", "n_rows", "first_event_id", "first_seq", "last_seq"],
        )

    def close(self) -> None:
        pass


def _least(a: int | None, b: int) -> int:
    return b if a is None else min(a, b)


def settle_stream(changes: DataFrame, gap_seconds: float, hold_seconds: float) -> DataFrame:
    """Settled documents of a stream of routed changes (`index, doc_id, seq, event_id`).

    Time is arrival time, so there is no watermark; timers fire without new input.  Needs the RocksDB state
    store provider.
    """
    narrow = changes.select("index", "doc_id", "seq", "event_id").mapInPandas(_combine, _PARTIAL)
    return narrow.groupBy("index", "doc_id").transformWithStateInPandas(
        statefulProcessor=SettleProcessor(int(gap_seconds * 1000), int(hold_seconds * 1000)),
        outputStructType=SETTLED,
        outputMode="append",
        timeMode="ProcessingTime",
    )
