"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from docloom.operators.netchange import changed_attrs
from docloom.operators.rules import TableFeed
from docloom.plans.sync import sync_batch
from docloom.session import local_session
from docloom.workload.inputs import Inputs
from docloom.workload.orders import ORDER_DOC
from docloom.workload.queries import QUERIES

HEADLINE = (
    "cdc_scan",
    "route_rules",
    "flatten_rows",
    "doc_query_full",
    "doc_query_changed",
    "net_row_change",
    "set_equal_prune",
    "changed_attrs",
    "decide_action",
    "apply_changes",
    "rebuild_full",
    "multi_attr",
    "doc_batches",
    "settle_split",
    "settle_batches",
    "event_tagging",
    "net_set_value",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_percent(spark, sf_dir: str) -> dict[str, float]:
    """Apply a feed that changes about 1 % of the documents to a table that is already built."""
    i = Inputs(spark, sf_dir)
    (table,) = i.new_tables(i.before)
    feeds = []
    for f in i.feeds:
        key = "o_orderkey" if f.table == "orders" else "l_orderkey"
        doc = F.coalesce(F.col(f"new.{key}"), F.col(f"old.{key}"))
        feeds.append(TableFeed(f.table, f.df.where(F.pmod(F.xxhash64(doc), F.lit(100)) == 0), f.pk))
    seconds = timed(lambda: sync_batch(spark, i.job([table]), i.after, feeds, batch_id=1, seq=1))
    read = timed(lambda: run(table.read()))
    return {"apply_1pct": seconds, "read_after_apply_1pct": read}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    run(QUERIES["doc_query_full"](spark, sf_dir))  # start the session's code paths

    times = {name: timed(lambda n=name: run(QUERIES[n](spark, sf_dir))) for name in names}
    extra = {}
    if not sys.argv[1:]:
        times.update(one_percent(spark, sf_dir))
        i = Inputs(spark, sf_dir)
        rows = sum(r.df.count() for r in i.routed)
        extra["row_changes"] = rows
        extra["changed_attrs_rows_per_sec"] = round(rows / times["changed_attrs"])
        extra["documents"] = ORDER_DOC.documents(spark, i.frames).count()
        assert changed_attrs(i.routed).count() > 0
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                **extra,
            }
        )
    )


if __name__ == "__main__":
    main()
