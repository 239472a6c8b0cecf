"""Inputs of the registered queries: base tables, their state before and after the feeds, and the feeds."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.rules import IngestRule, TableFeed, route
from docloom.operators.source import DocSource
from docloom.plans.sync import SyncJob
from docloom.plans.target import DocTable
from docloom.session import new_dir
from docloom.sources.feed import feed_from_flat, snapshot_as_inserts
from docloom.sources.tables import parquet_tables, spread
from docloom.workload import feeds as sql
from docloom.workload.orders import ORDER_DOC, RULES

# Fixed values of the checks: settle window over `events`, in seconds.
GAP = 6 * 3600
HOLD = 24 * 3600
LONG_HOLD = 716 * 3600
FLUSH = 600

LINE_IDENTITY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

USER_RULE = IngestRule("events", "user_id", "user_doc", {"event_type": ("kinds",), "value": ("spend",)})


class Inputs:
    """Everything the queries read from one folder of tables."""

    TABLES = ("orders", "lineitem", "customer", "nation", "region", "part")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def frames(self) -> dict[str, DataFrame]:
        frames = parquet_tables(self.spark, self.sf_dir, self.TABLES)
        return {
            **frames,
            "orders": spread(frames["orders"], "o_orderkey"),
            "lineitem": spread(frames["lineitem"], *LINE_IDENTITY),
        }

    @cached_property
    def orders_flat(self) -> DataFrame:
        return self.spark.sql(sql.F_ORDERS, orders=self.frames["orders"])

    @cached_property
    def lines_flat(self) -> DataFrame:
        return self.spark.sql(sql.F_LINES, lineitem=self.frames["lineitem"])

    @cached_property
    def orders_feed(self) -> TableFeed:
        return feed_from_flat("orders", self.orders_flat, sql.ORDER_COLUMNS, ("o_orderkey",))

    @cached_property
    def lines_feed(self) -> TableFeed:
        return feed_from_flat("lineitem", self.lines_flat, sql.LINE_COLUMNS, sql.LINE_KEY)

    @property
    def feeds(self) -> list[TableFeed]:
        return [self.orders_feed, self.lines_feed]

    @cached_property
    def routed(self):
        return route(self.feeds, RULES)

    @cached_property
    def before(self) -> dict[str, DataFrame]:
        return self._state(sql.before)

    @cached_property
    def after(self) -> dict[str, DataFrame]:
        return self._state(sql.after)

    def _state(self, pick) -> dict[str, DataFrame]:
        orders, lineitem = self.frames["orders"], self.frames["lineitem"]
        return {
            **self.frames,
            "orders": self.spark.sql(pick(sql.F_ORDERS, sql.ORDER_COLUMNS), orders=orders),
            "lineitem": self.spark.sql(pick(sql.F_LINES, sql.LINE_COLUMNS), lineitem=lineitem),
        }

    @cached_property
    def events_feed(self) -> TableFeed:
        e = self.table("events")
        return snapshot_as_inserts("events", e, F.col("event_id"), F.col("event_id"), F.col("ts"), ("event_id",))

    @cached_property
    def user_changes(self):
        return route([self.events_feed], [USER_RULE])

    def new_table(self, name: str = "order_doc") -> DocTable:
        return DocTable(self.spark, new_dir(self.spark, name))

    def new_tables(self, state: dict[str, DataFrame], n: int = 1, **position) -> list[DocTable]:
        """Targets rebuilt from a state of the base tables; all but the first take the documents from the first, by part."""
        tables = [self.new_table() for _ in range(n)]
        tables[0].rebuild(ORDER_DOC.documents(self.spark, state), "order_id", ORDER_DOC.parts, **position)
        for t in tables[1:]:
            t.rebuild(tables[0].read(), "order_id", ORDER_DOC.parts, laid_out=True, **position)
        return tables

    def job(self, tables: list[DocTable], source: DocSource = ORDER_DOC) -> SyncJob:
        return SyncJob({source.name: source}, RULES, {source.name: tables})


def flat(df: DataFrame) -> DataFrame:
    """Arrays as comma-joined text, 32-bit integers as bigint, so results compare across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
