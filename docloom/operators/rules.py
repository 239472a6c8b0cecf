"""Routing: which document a row change touches, and with which column images.

Rules are configuration, so all rules of a table become one generator over its feed.  Images stay typed structs of the
mapped columns; a side that does not exist is a struct of NULLs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.coerce import comparable, to_doc_id
from docloom.operators.source import DocSource


#: Columns of a routed change beside its key and images.
TOUCHED = ("index", "table", "seq", "rule_id", "row_no", "sub_no", "event_id", "ts", "action", "doc_id")


class RuleError(ValueError):
    """A rule does not fit its feed or its document source."""


@dataclass(frozen=True)
class IngestRule:
    """Changes of `table` concern the document of `index` whose id stands in `id_field`.

    `column_map` says which document columns each table column feeds.
    """

    table: str
    id_field: str
    index: str
    column_map: Mapping[str, Sequence[str]]

    def check(self, sources: Mapping[str, DocSource], columns: Mapping[str, Iterable[str]]) -> None:
        """Refuse a rule whose source, table or mapped document columns do not exist."""
        source = sources.get(self.index)
        if source is None:
            raise RuleError(f"no document source for index {self.index!r}")
        if self.table not in source.tables:
            raise RuleError(f"table {self.table!r} is not part of the query of {self.index!r}")
        if not self.column_map:
            raise RuleError(f"rule for {self.table!r} maps no columns")
        known = set(columns[self.index])
        unknown = sorted({a for attrs in self.column_map.values() for a in attrs} - known)
        if unknown:
            raise RuleError(f"rule for {self.table!r} feeds unknown columns {unknown}")


@dataclass(frozen=True)
class TableFeed:
    """Decoded row changes of one table.

    `df` has `seq, event_id, ts, action, old, new` and optionally `row_no`; `old` and `new` are structs of the
    table's columns.  `pk` lists the primary key columns; without one, all columns together are the key.
    """

    table: str
    df: DataFrame
    pk: Sequence[str] = ()

    def image_fields(self) -> list[T.StructField]:
        return self.df.schema["new"].dataType.fields

    def key_columns(self) -> list[str]:
        return list(self.pk) or [f.name for f in self.image_fields()]


@dataclass(frozen=True)
class RoutedChanges:
    """Row changes of one table tied to documents of one index, with equal column maps.

    `one_row` says that the table's key is the document id, so a document has at most one row in it; `by_seq` says that
    `seq` and `sub_no` alone order the changes.
    """

    index: str
    table: str
    columns: tuple[str, ...]
    column_map: Mapping[str, Sequence[str]]
    one_row: bool
    df: DataFrame
    by_seq: bool = False



def _value(side: str, f: T.StructField) -> Column:
    return comparable(F.col(f"{side}.{f.name}"), f.dataType)


def image(side: str, fields: Sequence[T.StructField], columns: Iterable[str], absent: Column) -> Column:
    """The mapped columns of one side in table column order, all NULL where that side is absent."""
    wanted = set(columns)
    return F.struct(*[F.when(~absent, _value(side, f)).alias(f.name) for f in fields if f.name in wanted])


def row_key(fields: Sequence[T.StructField], columns: Sequence[str], from_new: Column) -> Column:
    """Key of the row that an insert creates or that an update or delete found."""
    by_name = {f.name: f for f in fields}
    return F.struct(
        *[F.when(from_new, _value("new", by_name[c])).otherwise(_value("old", by_name[c])).alias(c) for c in columns]
    )


def change_order() -> Column:
    """Total order of row changes: feed position, rule, row in the event, part of a split update."""
    return F.struct("seq", "rule_id", "row_no", "sub_no")


def change_number(r: RoutedChanges) -> Column:
    """The same order as a number of fixed width, which aggregates can hold in place.  Positions from 2^62 on are refused
    where `seq` alone decides; else rule numbers go up to 2^15."""
    if r.by_seq:
        return F.col("seq").cast("bigint") * 2 + F.col("sub_no")
    rest = F.col("rule_id").cast("bigint") * (1 << 32) + F.col("row_no").cast("bigint") * 2 + F.col("sub_no")
    return F.col("seq").cast("decimal(19,0)") * F.lit(1 << 47).cast("decimal(15,0)") + rest.cast("decimal(15,0)")


def _steps(rule: IngestRule, rule_id: int, types: Mapping[str, T.DataType]) -> Column:
    """What one rule makes of a change: an array of one step, or of two if the row moves to another document."""
    old_id = to_doc_id(F.col(f"old.{rule.id_field}"), types[rule.id_field])
    new_raw = F.col(f"new.{rule.id_field}")
    new_id = to_doc_id(new_raw, types[rule.id_field])

    def step(sub_no: int, action: Column, doc_id: Column) -> Column:
        return F.struct(
            F.lit(rule_id).alias("rule_id"), F.lit(rule.index).alias("index"), F.lit(rule.id_field).alias("id_field"),
            F.lit(sub_no).alias("sub_no"), action.alias("action"), doc_id.alias("doc_id"),
        )

    moves = (F.col("event_action") == "update") & new_raw.isNotNull() & (old_id != new_id)
    stays = step(0, F.col("event_action"), F.when(F.col("event_action") == "insert", new_id).otherwise(old_id))
    both = F.array(step(0, F.lit("delete"), old_id), step(1, F.lit("insert"), new_id))
    return F.when(moves, both).otherwise(F.array(stays))


def fan_out(feed: TableFeed, rules: Mapping[int, IngestRule]) -> DataFrame:
    """The changes of `feed` with what each of its rules, by number, makes of them: one generator, so one pass over the feed
    however many rules there are.

    An update that moves a row to another document becomes a delete from the old one followed by an insert into
    the new one.  A NULL new id means that the id did not change.  `event_action` is the action as it came, and `lead` marks
    one step of each change.
    """
    types = {f.name: f.dataType for f in feed.image_fields()}
    for rule in rules.values():
        if rule.id_field not in types:
            raise RuleError(f"table {feed.table!r} has no column {rule.id_field!r}")
    known = F.col("action").isin("insert", "update", "delete")
    unknown = F.raise_error(F.concat(F.lit("unknown row action: "), F.coalesce("action", F.lit("NULL"))))
    row_no = F.col("row_no") if "row_no" in feed.df.columns else F.lit(0)
    events = feed.df.select(
        "seq",
        row_no.cast("int").alias("row_no"),
        "event_id",
        "ts",
        F.when(known, F.col("action")).otherwise(unknown.cast("string")).alias("event_action"),
        "old",
        "new",
    )
    made = [_steps(rule, rule_id, types) for rule_id, rule in rules.items()]
    steps = events.withColumn("_step", F.explode(F.concat(*made) if len(made) > 1 else made[0]))
    lead = (F.col("_step.rule_id") == min(rules)) & (F.col("_step.sub_no") == 0)
    kept = ("seq", "row_no", "event_id", "ts", "event_action", "old", "new")
    return steps.select(F.lit(feed.table).alias("table"), *kept, "_step.*", lead.alias("lead"))


def apply_rules(feed: TableFeed, rules: Mapping[int, IngestRule]) -> RoutedChanges:
    """Row changes of `feed` as changes of the documents of rules, by number, that agree in index and column map."""
    rule = next(iter(rules.values()))
    fields = feed.image_fields()
    steps = fan_out(feed, rules)
    absent = sorted(set(feed.key_columns()) - {f.name for f in fields})
    if absent:
        raise RuleError(f"table {feed.table!r} has no key columns {absent}")
    mapped = tuple(f.name for f in fields if f.name in rule.column_map)
    if not mapped:
        raise RuleError(f"rule for {feed.table!r} maps none of its columns")
    inserts, deletes = F.col("action") == "insert", F.col("action") == "delete"
    df = steps.select(
        *TOUCHED,
        row_key(fields, feed.key_columns(), inserts).alias("pk"),
        image("old", fields, mapped, inserts).alias("old"),
        image("new", fields, mapped, deletes).alias("new"),
    )
    alone = len(rules) == 1
    one_row = alone and tuple(feed.pk) == (rule.id_field,)
    by_seq = alone and "row_no" not in feed.df.columns
    return RoutedChanges(rule.index, feed.table, mapped, rule.column_map, one_row, df, by_seq)


def apply_rule(feed: TableFeed, rule: IngestRule, rule_id: int = 0) -> RoutedChanges:
    """Row changes of `feed` as changes of the rule's documents."""
    return apply_rules(feed, {rule_id: rule})


def route(feeds: Iterable[TableFeed], rules: Sequence[IngestRule]) -> list[RoutedChanges]:
    """All rules over all feeds.

    Rules that agree in index, table and column map share one pass over the feed and one result, so their changes of a
    document are folded together; order within an event follows the order of the rules.
    """
    feeds = list(feeds)
    groups: dict[tuple, tuple[TableFeed, dict[int, IngestRule]]] = {}
    for rule_id, rule in enumerate(rules):
        for n, feed in enumerate(feeds):
            if feed.table == rule.table:
                shape = (n, rule.index, tuple((k, tuple(v)) for k, v in sorted(rule.column_map.items())))
                groups.setdefault(shape, (feed, {}))[1][rule_id] = rule
    return [apply_rules(feed, same) for feed, same in groups.values()]


def touched(routed: Iterable[RoutedChanges]) -> DataFrame:
    """One narrow row per row change: what queueing and positions need, without keys and images."""
    narrow = [r.df.select(*TOUCHED) for r in routed]
    if not narrow:
        raise RuleError("no rule matches any feed")
    return reduce(DataFrame.unionByName, narrow)


def match_rules(events: DataFrame, rules: Sequence[IngestRule]) -> DataFrame:
    """Events with the rules of their table, one row per match; several rules may match one event.

    The rule list is configuration, a few rows held by the driver, so it is a bounded broadcast.
    """
    rows = [(i, r.table, r.index, r.id_field) for i, r in enumerate(rules)]
    table = events.sparkSession.createDataFrame(rows, "rule_id int, table string, index string, id_field string")
    return events.join(F.broadcast(table), "table")


def touched_by(feeds: Iterable[TableFeed], rules: Sequence[IngestRule]) -> DataFrame:
    """The same for all rules over all feeds, each feed read once; `lead` marks one row of each row change.
    """
    narrow = []
    for feed in feeds:
        mine = {i: r for i, r in enumerate(rules) if r.table == feed.table}
        if mine:
            narrow.append(fan_out(feed, mine).select(*TOUCHED, "event_action", "lead"))
    if not narrow:
        raise RuleError("no rule matches any feed")
    return reduce(DataFrame.unionByName, narrow)


def check_rules(
    rules: Iterable[IngestRule], sources: Mapping[str, DocSource], columns: Mapping[str, Iterable[str]]
) -> None:
    for rule in rules:
        rule.check(sources, columns)


__all__ = [
    "IngestRule",
    "RoutedChanges",
    "RuleError",
    "TableFeed",
    "apply_rule",
    "apply_rules",
    "change_number",
    "change_order",
    "check_rules",
    "fan_out",
    "match_rules",
    "route",
    "touched",
    "touched_by",
]
