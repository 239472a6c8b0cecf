"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import coerce
from docloom.operators import netchange, pending, positions, settling, valuediff
from docloom.operators.decide import actions_per_part, decide
from docloom.operators.rules import IngestRule, TableFeed, apply_rule, fan_out, route, touched, touched_by
from docloom.operators.source import DocSource, latest_per_document
from docloom.plans import maintenance
from docloom.plans.commits import applied_up_to, commits, current_positions, parts_apart, replicas_agree
from docloom.plans.rebuild import RebuildLog, rebuild_and_replay, rebuild_group, rebuild_unless
from docloom.plans.recovery import recover, recovery_plan, target_readiness
from docloom.plans.status import sync_status as status_of
from docloom.plans.sync import SyncJob, decided_documents, sync_batch
from docloom.plans.sync import sync_counters as count_sync
from docloom.session import new_dir, staged
from docloom.sources import feed as feeds
from docloom.streaming.follow import Follower
from docloom.workload import feeds as sql
from docloom.workload.inputs import FLUSH, GAP, HOLD, LONG_HOLD, Inputs, flat
from docloom.workload.orders import LINES_RULE, ORDER_DOC, ORDERS_RULE, RULES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: flat(fn(Inputs(spark, sf_dir)))
    return fn


def _max(df: DataFrame, c) -> int:
    return df.agg(F.max(c)).first()[0]


# sources ------------------------------------------------------------------------------------------------------


@query
def cdc_scan(i: Inputs) -> DataFrame:
    root = new_dir(i.spark, "feed")
    feeds.write_feed(i.feeds, root)
    stored = feeds.read_feed(i.spark, root, {"orders": ["o_orderkey"], "lineitem": sql.LINE_KEY})
    return touched_by(stored, RULES).select("table", "seq", "action", "doc_id")


@query
def cdc_table_prune(i: Inputs) -> DataFrame:
    root = new_dir(i.spark, "feed")
    feeds.write_feed(i.feeds, root)
    (lines,) = feeds.read_feed(i.spark, root, {"lineitem": sql.LINE_KEY})
    return lines.df.groupBy("action").agg(F.count("*").alias("n_rows"), F.sum("seq").alias("seq_sum"))


@query
def snapshot_as_inserts(i: Inputs) -> DataFrame:
    dump = feeds.snapshot_as_inserts(
        "orders", i.before["orders"], F.lit(-1), F.lit(-1), F.timestamp_micros(F.lit(0)), ("o_orderkey",)
    )
    log = i.orders_feed
    log = TableFeed("orders", log.df.withColumn("ts", F.col("ts").cast("timestamp")), log.pk)
    both = TableFeed("orders", dump.df.unionByName(log.df), ("o_orderkey",))
    net = netchange.net_changes(apply_rule(both, ORDERS_RULE))
    return net.select(
        "doc_id", "is_insert", "is_update", "is_delete",
        F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price"),
    )


@query
def resume_from_position(i: Inputs) -> DataFrame:
    half = _max(i.orders_flat, "seq") // 2
    (table,) = i.new_tables(i.before, seq=half)
    rest = positions.resume_after(i.orders_feed.df, table.current().seq)
    return rest.select("seq", "action", F.col("new.o_orderkey").alias("new_key"))


@query
def wait_position(i: Inputs) -> DataFrame:
    half = _max(i.orders_flat, "seq") // 2
    (table,) = i.new_tables(i.before, seq=half)
    (saved,) = current_positions(commits(i.spark, {"order_doc": table})).select("seq").collect()
    seq = saved["seq"]
    ahead = applied_up_to(commits(i.spark, {"order_doc": table}), half + 1).first()["applied"]
    return (
        positions.already_applied(i.orders_feed.df, seq)
        .groupBy("action")
        .agg(F.count("*").alias("n_applied"))
        .withColumn("next_applied", F.lit(ahead))
    )


# routing ------------------------------------------------------------------------------------------------------


@query
def route_rules(i: Inputs) -> DataFrame:
    more = (*RULES, IngestRule("orders", "o_custkey", "customer_doc", {"o_totalprice": ("spend",)}))
    routed = [fan_out(f, {n: r for n, r in enumerate(more) if r.table == f.table}) for f in i.feeds]
    # a moved row is two steps of one match
    columns = ("rule_id", "index", "id_field", "table", "seq", F.col("event_action").alias("action"))
    return reduce(DataFrame.unionByName, [r.where("sub_no = 0").select(*columns) for r in routed])


def _raw_events(i: Inputs) -> DataFrame:
    """Multi-row events made of lines: inserts and deletes with three rows, updates with two old/new pairs."""
    def row(k):
        return F.struct("l_orderkey", (F.col("l_quantity") + k).alias("l_quantity"), F.lit(k).alias("row_id"))

    three = F.array(row(0), row(1), row(2))
    four = F.array(row(0), row(1), row(2), row(3))
    kind = F.col("l_linenumber") % 3
    action = F.when(kind == 0, "insert").when(kind == 1, "update").otherwise("delete")
    return i.frames["lineitem"].select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.lit("lineitem").alias("table"),
        action.alias("action"),
        F.when(kind == 1, four).otherwise(three).alias("rows"),
    )


@query
def flatten_rows(i: Inputs) -> DataFrame:
    return feeds.flatten_rows(_raw_events(i)).select(
        "seq", "action", "row_no", F.col("old.l_quantity").alias("old_quantity"),
        F.col("new.l_quantity").alias("new_quantity"), F.col("old.row_id").alias("old_row"),
        F.col("new.row_id").alias("new_row"),
    )


@query
def row_count(i: Inputs) -> DataFrame:
    return _raw_events(i).groupBy("action").agg(
        F.count("*").alias("n_events"), F.sum(feeds.logical_rows()).alias("n_rows")
    )


@query
def doc_id_extract(i: Inputs) -> DataFrame:
    e = i.table("events").withColumn("text_id", F.nullif(F.col("user_id"), F.lit(7)).cast("string"))
    return e.select(
        "event_id",
        coerce.to_doc_id(F.col("text_id"), e.schema["text_id"].dataType).alias("doc_id"),
        coerce.to_doc_id(F.nullif(F.col("user_id"), F.lit(8)), e.schema["user_id"].dataType).alias("number_id"),
    )


@query
def doc_move_split(i: Inputs) -> DataFrame:
    # updates of the lowest priority come without a new id, which means that the id is unchanged
    blank = (F.col("action") == "update") & (F.col("old.o_orderpriority") == "5-LOW")
    df = i.orders_feed.df.withColumn(
        "new", F.when(blank, F.col("new").withField("o_orderkey", F.lit(None).cast("bigint"))).otherwise(F.col("new"))
    )
    r = apply_rule(TableFeed("orders", df, ("o_orderkey",)), ORDERS_RULE)
    return r.df.select(
        "seq", "sub_no", "action", "doc_id", F.col("old.o_totalprice").alias("old_price"),
        F.col("new.o_totalprice").alias("new_price"),
    )


@query
def column_prune(i: Inputs) -> DataFrame:
    r = apply_rule(i.lines_feed, LINES_RULE)
    sides = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("old", "new") for c in r.columns]
    return r.df.select(
        "seq", "doc_id", "action", F.lit(",".join(r.columns)).alias("columns"), *sides,
        (F.col("old").isNull() | F.col("new").isNull()).alias("image_missing"),
    )


@query
def pk_fallback(i: Inputs) -> DataFrame:
    keyless = apply_rule(TableFeed("lineitem", i.lines_feed.df), LINES_RULE)
    net = netchange.net_changes(keyless)
    return net.groupBy("doc_id").agg(
        F.count("*").alias("n_keys"),
        F.count_if("is_insert").alias("n_insert"),
        F.count_if("is_update").alias("n_update"),
        F.count_if("is_delete").alias("n_delete"),
        F.min("pk.l_tax").alias("least_tax"),
    )


@query
def part_route(i: Inputs) -> DataFrame:
    o = i.frames["orders"]
    return o.select("o_orderkey", coerce.part_of(F.col("o_orderkey"), 7).alias("part"))


# documents ----------------------------------------------------------------------------------------------------


@query
def doc_query_full(i: Inputs) -> DataFrame:
    return ORDER_DOC.documents(i.spark, i.frames)


CUSTOMER_DOC = DocSource(
    name="customer_doc",
    query="""
        SELECT c.c_custkey AS `:id`, c.c_name AS `name:field`, c.c_mktsegment AS `:attr_string`,
               c.c_nationkey AS `:attr_uint`, c.c_custkey * -3 AS `minus:attr_bigint`,
               c.c_acctbal / 7 AS `balance:attr_float`,
               concat_ws(',', c.c_nationkey, c.c_custkey) AS `pair:attr_multi`,
               array(c.c_custkey, c.c_nationkey) AS `pair64:attr_multi_64`
        FROM {customer} c""",
    tables={"customer": "c_custkey"},
)


@query
def typed_alias(i: Inputs) -> DataFrame:
    return CUSTOMER_DOC.documents(i.spark, i.frames)


@query
def doc_query_changed(i: Inputs) -> DataFrame:
    # the ids cut down two base tables, so they are worked out once
    ids = staged(netchange.changed_attrs(i.routed).select("doc_id"), "ids")
    return ORDER_DOC.documents(i.spark, i.after, ids=ids)


MULTI_DOC = DocSource(
    name="multi_doc",
    query="""
        SELECT x.l_orderkey AS `id:id`,
               listagg(DISTINCT (x.l_partkey << 4) | x.l_linenumber, ',') AS `line_codes:attr_multi`,
               collect_set(x.l_suppkey) AS `suppliers:attr_multi_64`
        FROM {lineitem} x GROUP BY x.l_orderkey""",
    tables={"lineitem": "l_orderkey"},
)


@query
def multi_attr(i: Inputs) -> DataFrame:
    return MULTI_DOC.documents(i.spark, i.frames)


@query
def doc_dedupe(i: Inputs) -> DataFrame:
    rows = i.frames["lineitem"].select(
        F.col("l_orderkey").alias("id"), "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity"
    )
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return latest_per_document(rows, "id", order).drop("l_shipdate")


@query
def coerce_types(i: Inputs) -> DataFrame:
    o = i.frames["orders"].select(
        "o_orderkey",
        (F.col("o_totalprice") - 200000).alias("number"),
        F.nullif(F.col("o_custkey"), F.lit(5)).alias("maybe"),
        F.nullif(F.col("o_custkey"), F.lit(6)).cast("string").alias("text"),
        F.concat_ws(",", "o_custkey", F.lit(""), F.col("o_orderkey")).alias("list"),
    )
    t = {f.name: f.dataType for f in o.schema.fields}
    return o.select(
        "o_orderkey",
        coerce.typed(F.col("number"), t["number"], "attr_uint").alias("as_uint"),
        coerce.typed(F.col("number"), t["number"], "attr_bigint").alias("as_bigint"),
        coerce.typed(F.col("number") / 7, t["number"], "attr_float").alias("as_float"),
        coerce.typed(F.col("maybe"), t["maybe"], "attr_uint").alias("maybe_uint"),
        coerce.typed(F.col("maybe"), t["maybe"], "attr_string").alias("maybe_string"),
        coerce.typed(F.col("text"), t["text"], "attr_uint").alias("text_uint"),
        coerce.typed(F.concat(F.lit("-"), "text"), t["text"], "attr_bigint").alias("text_bigint"),
        coerce.typed(F.col("list"), t["list"], "attr_multi").alias("as_multi"),
    )


@query
def strip_nul(i: Inputs) -> DataFrame:
    d = i.table("documents").withColumn("raw", F.concat(F.lit("\u0000"), "text", F.lit("\u0000"), "source"))
    clean = coerce.strip_nul(F.col("raw"))
    return d.select("doc_id", F.md5(clean.cast("binary")).alias("digest"), F.length(clean).alias("n"))


@query
def binary_compare(i: Inputs) -> DataFrame:
    def side(text):
        return F.struct("doc_id", text.cast("binary").alias("text"), F.col("source").cast("binary").alias("source"))

    d = i.table("documents").select(
        F.col("doc_id").alias("seq"), F.col("doc_id").alias("event_id"), F.timestamp_micros(F.lit(0)).alias("ts"),
        F.lit("update").alias("action"), side(F.col("text")).alias("old"),
        side(F.concat("text", F.when(F.col("lang") == "en", "!").otherwise(""))).alias("new"),
    )
    rule = IngestRule("documents", "doc_id", "texts", {"text": ("body",), "source": ("origin",)})
    return netchange.changed_columns(apply_rule(TableFeed("documents", d, ("doc_id",)), rule)).select(
        "doc_id", "columns"
    )


# net changes --------------------------------------------------------------------------------------------------


@query
def net_row_change(i: Inputs) -> DataFrame:
    orders = netchange.net_changes(i.routed[0]).select(
        "table", "doc_id", F.col("pk.o_orderkey").alias("key"), "is_insert", "is_update", "is_delete",
        F.col("old.o_totalprice").alias("old_value"), F.col("new.o_totalprice").alias("new_value"),
    )
    lines = netchange.net_changes(i.routed[1]).select(
        "table", "doc_id", F.col("pk.generation").cast("bigint").alias("key"), "is_insert", "is_update", "is_delete",
        F.col("old.l_quantity").alias("old_value"), F.col("new.l_quantity").alias("new_value"),
    )
    return orders.unionByName(lines)


@query
def prune_noop(i: Inputs) -> DataFrame:
    kept = [netchange.prune_unchanged(netchange.net_changes(r)).select("table", "doc_id") for r in i.routed]
    return kept[0].unionByName(kept[1]).groupBy("table", "doc_id").agg(F.count("*").alias("n_rows"))


@query
def set_equal_prune(i: Inputs) -> DataFrame:
    return netchange.changed_column_flags(i.routed[1]).select("doc_id")


@query
def changed_columns(i: Inputs) -> DataFrame:
    both = [netchange.changed_columns(r).select("table", "doc_id", "columns") for r in i.routed]
    return both[0].unionByName(both[1])


@query
def changed_attrs(i: Inputs) -> DataFrame:
    return netchange.changed_attrs(i.routed)


@query
def changed_docs(i: Inputs) -> DataFrame:
    changed = staged(netchange.changed_attrs(i.routed).select("index", "doc_id"), "changed")
    same = netchange.unchanged_docs(i.routed, changed)
    return changed.select("doc_id", F.lit(True).alias("changed")).unionByName(
        same.select("doc_id", F.lit(False).alias("changed"))
    )


@query
def net_plain_value(i: Inputs) -> DataFrame:
    e = i.table("events").select(
        "user_id", "event_id", F.col("event_type").alias("old"),
        F.when(F.col("value") > 20, "purchase").otherwise(F.col("event_type")).alias("new"),
    )
    return valuediff.net_plain_value(e, ["user_id"], "event_id", "old", "new")


@query
def net_set_value(i: Inputs) -> DataFrame:
    e = i.table("events").select(
        "user_id", "event_id",
        F.when(F.col("value") >= 10, F.col("event_type")).alias("old"),
        F.when(F.col("event_type") == "view", "click").when(F.col("event_type") == "click", "purchase")
        .when(F.col("event_type") == "purchase", "error").when(F.col("value") < 5, "signup").alias("new"),
    )
    return valuediff.net_set_value(e, ["user_id"], "event_id", "old", "new")


# decisions and applying ---------------------------------------------------------------------------------------


def _decided(i: Inputs) -> DataFrame:
    changed = staged(netchange.changed_attrs(i.routed).select("doc_id", "attrs"), "changed")
    return decided_documents(i.spark, ORDER_DOC, i.after, changed)


@query
def decide_action(i: Inputs) -> DataFrame:
    return _decided(i).select("doc_id", "part", "action", "attrs", "doc.title_text", "doc.total", "doc.suppliers")


@query
def actions_by_part(i: Inputs) -> DataFrame:
    return actions_per_part(_decided(i))


QUERIES["actions_per_part"] = QUERIES.pop("actions_by_part")


@query
def sync_counters(i: Inputs) -> DataFrame:
    return count_sync(i.routed, {f.table: f.df for f in i.feeds}, _decided(i))


@query
def apply_changes(i: Inputs) -> DataFrame:
    tables = i.new_tables(i.before)
    sync_batch(i.spark, i.job(tables), i.after, i.feeds, batch_id=1, seq=_max(i.orders_flat, "seq"))
    return tables[0].read()


@query
def apply_partial_update(i: Inputs) -> DataFrame:
    # the target lacks documents in status O, so updates in place find nothing there
    table = i.new_table()
    docs = ORDER_DOC.documents(i.spark, i.before)
    table.rebuild(docs.where(F.col("status") != "O"), "order_id", ORDER_DOC.parts)
    sync_batch(i.spark, i.job([table]), i.after, i.feeds, batch_id=1, seq=1, upsert_missing=False)
    return table.read()


@query
def apply_deletes(i: Inputs) -> DataFrame:
    (table,) = i.new_tables(i.before)
    table.apply(_decided(i).where(F.col("action") == "delete"), batch_id=1)
    return table.read().select("order_id", "total")


@query
def multi_target_apply(i: Inputs) -> DataFrame:
    tables = i.new_tables(i.before, n=2)
    sync_batch(i.spark, i.job(tables), i.after, i.feeds, batch_id=1, seq=1)
    reads = [t.read().select(F.lit(k).alias("replica"), "*") for k, t in enumerate(tables)]
    return reads[0].unionByName(reads[1])


@query
def idempotent_replay(i: Inputs) -> DataFrame:
    tables = i.new_tables(i.before)
    for _ in range(2):
        sync_batch(i.spark, i.job(tables), i.after, i.feeds, batch_id=1, seq=1)
    # the same rows under a new batch number: documents are read again, so nothing changes
    sync_batch(i.spark, i.job(tables), i.after, i.feeds, batch_id=2, seq=1)
    version = tables[0].current().version
    return tables[0].read().withColumn("n_versions", F.lit(version))


@query
def commit_log(i: Inputs) -> DataFrame:
    tables = i.new_tables(i.before, seq=0)
    sync_batch(i.spark, i.job(tables), i.after, i.feeds, batch_id=1, seq=_max(i.orders_flat, "seq"))
    return commits(i.spark, {"order_doc": tables[0]}).select(
        "target", "version", "kind", "batch_id", "seq", "n_replace", "n_update", "n_delete"
    )


# queue --------------------------------------------------------------------------------------------------------


@query
def doc_batches(i: Inputs) -> DataFrame:
    b = pending.doc_batches(touched(i.user_changes))
    return b.select(
        "index", "doc_id", "n_rows", "first_event_id", "first_seq", "last_seq",
        F.unix_micros(F.col("first_ts").cast("timestamp")).alias("first_us"),
        F.unix_micros(F.col("last_ts").cast("timestamp")).alias("last_us"),
    )


@query
def queue_stats(i: Inputs) -> DataFrame:
    changes = touched(i.user_changes).unionByName(touched(i.routed))
    return pending.queue_stats(pending.doc_batches(changes))


def _split(i: Inputs) -> DataFrame:
    changes = touched(i.user_changes)
    now = F.timestamp_micros(F.lit(_max(changes, F.unix_micros(F.col("ts").cast("timestamp")))))
    return pending.settle_split(pending.doc_batches(changes), now, GAP, LONG_HOLD)


@query
def settle_split(i: Inputs) -> DataFrame:
    return _split(i).select("index", "doc_id", "n_rows", "ready")


@query
def safe_position(i: Inputs) -> DataFrame:
    last = _max(i.table("events"), "event_id")
    waiting = pending.safe_position(_split(i).where(~F.col("ready")), F.lit(last))
    nothing = pending.safe_position(_split(i).where(F.col("n_rows") < 0), F.lit(last))
    return waiting.select(F.lit("waiting").alias("queue"), "event_id").unionByName(
        nothing.select(F.lit("empty").alias("queue"), "event_id")
    )


@query
def settle_batches(i: Inputs) -> DataFrame:
    return settling.settle_batches(touched(i.user_changes), GAP, HOLD, FLUSH)


@query
def event_tagging(i: Inputs) -> DataFrame:
    e = i.table("events").select(F.col("event_id").alias("seq"), "event_type")
    return positions.tag_positions(e, F.col("event_type") == "purchase", block=1000).select("seq", "event_id")


@query
def stream_apply(i: Inputs) -> DataFrame:
    # documents settle at once, so every micro-batch applies what it brought
    root = new_dir(i.spark, "feed")
    feeds.write_feed(i.feeds, root)
    (table,) = i.new_tables(i.before, seq=0)
    last = max(_max(f.df, "seq") for f in i.feeds)  # the feed is stored as a whole
    follower = Follower(
        i.spark, i.job([table]), lambda: i.after, root, {"orders": ["o_orderkey"], "lineitem": sql.LINE_KEY},
        new_dir(i.spark, "follower"), gap_seconds=0, hold_seconds=0,
        high_water=lambda: {"orders": last, "lineitem": last},
    )
    follower.start(heartbeat=False, trigger={"availableNow": True}).awaitTermination()
    return table.read().withColumn("seq", F.lit(table.current().seq))


# rebuild and upkeep -------------------------------------------------------------------------------------------


@query
def rebuild_full(i: Inputs) -> DataFrame:
    return i.new_tables(i.frames)[0].read()


@query
def rebuild_one_part(i: Inputs) -> DataFrame:
    (table,) = i.new_tables(i.before)
    table.rebuild_part(ORDER_DOC.part_documents(i.spark, i.after, 1), 1)
    return table.read()


@query
def rebuild_swap(i: Inputs) -> DataFrame:
    (table,) = i.new_tables(i.before)
    built = table.build(ORDER_DOC.documents(i.spark, i.after), "order_id", ORDER_DOC.parts)
    old = table.read()
    table.publish(built)
    return old.select(F.lit("old").alias("state"), "*").unionByName(table.read().select(F.lit("new").alias("state"), "*"))


@query
def rebuild_then_replay(i: Inputs) -> DataFrame:
    # the build reads the state before all changes; only the replay brings them
    (table,) = i.new_tables(i.before, seq=0)
    log = RebuildLog(i.spark, new_dir(i.spark, "log"))
    states = iter([i.before, i.after])
    nothing_yet = [TableFeed(f.table, f.df.where(F.col("seq") < 0), f.pk) for f in i.feeds]
    stored = iter([nothing_yet, i.feeds])
    rebuild_and_replay(i.spark, i.job([table]), lambda: next(states), log, lambda: next(stored))
    return table.read().withColumn("seq", F.lit(table.current().seq))


@query
def build_mode_replay(i: Inputs) -> DataFrame:
    (table,) = i.new_tables(i.before, seq=0)
    sync_batch(i.spark, i.job([table]), i.after, i.feeds, batch_id=1, seq=77, advance=False)
    return table.read().withColumn("seq", F.lit(table.current().seq))


@query
def rebuild_log(i: Inputs) -> DataFrame:
    table = i.new_table()
    job = i.job([table])
    log = RebuildLog(i.spark, new_dir(i.spark, "log"))
    rebuild_group(i.spark, job, i.before, log, seq=0, build_id="first")
    schema = ORDER_DOC.schema(i.spark, i.after)
    rebuild_unless(i.spark, job, i.after, log, lambda *_: table.is_ready(schema), seq=0, build_id="skipped")
    rebuild_unless(i.spark, job, i.after, log, lambda *_: False, seq=0, build_id="second")
    sizes = [
        table.read(version=v).agg(F.count("*").alias("n_docs")).select(F.lit(b).alias("build_id"), "n_docs")
        for v, b in ((1, "first"), (2, "second"))
    ]
    return log.read().join(sizes[0].unionByName(sizes[1]), "build_id").select(
        "build_id", "indexes", "success", "n_docs", (F.col("finished_at") >= F.col("started_at")).alias("finished")
    )


@query
def target_ready(i: Inputs) -> DataFrame:
    good, other, missing = i.new_tables(i.frames)[0], i.new_table(), i.new_table()
    other.rebuild(ORDER_DOC.documents(i.spark, i.frames).drop("suppliers"), "order_id", ORDER_DOC.parts)
    ready = target_readiness(i.spark, i.job([good, other, missing]), i.frames)
    docs = [
        t.read().agg(F.count("*").alias("n_docs")).select(F.lit(k).alias("replica"), "n_docs")
        for k, t in enumerate((good, other))
    ]
    return ready.join(docs[0].unionByName(docs[1]), "replica", "left")


def _row_hashes(df: DataFrame) -> DataFrame:
    """Each row as 128 bits of hashes, in which a null is told from a value: what rows are compared by."""
    cells = [c for name in df.columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return df.select(*[F.xxhash64(F.lit(seed), *cells).alias(f"h{seed}") for seed in (0, 1)])


@query
def replica_agreement(i: Inputs) -> DataFrame:
    a, b = i.new_tables(i.before, n=2, seq=0)
    out = []
    for step in ("rebuilt", "one ahead", "both"):
        if step != "rebuilt":
            sync_batch(
                i.spark, i.job([a] if step == "one ahead" else [a, b]), i.after, i.feeds, batch_id=1,
                seq=_max(i.orders_flat, "seq"),
            )
        row = replicas_agree(i.spark, {"a": a, "b": b}).first()
        held = [_row_hashes(flat(t.read(version=t.current().version))) for t in (a, b)]
        both = held[0].withColumn("n", F.lit(1)).unionByName(held[1].withColumn("n", F.lit(-1)))
        apart = both.groupBy("h0", "h1").agg(F.abs(F.sum("n")).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_apart")
        )
        n_parts = F.lit(parts_apart(i.spark, {"a": a, "b": b}).count()).cast("bigint").alias("n_parts_apart")
        out.append(
            apart.select(
                F.lit(step).alias("step"), F.lit(row["n_states"]).cast("bigint").alias("n_states"),
                F.lit(row["agree"]).alias("agree"), F.lit(b.current().seq).cast("bigint").alias("seq"), "n_apart",
                n_parts,
            )
        )
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def recovery(i: Inputs) -> DataFrame:
    """The documents after carrying out the plan: an index with replicas apart, one with old columns, one that resumes."""
    first, second, stale, kept = i.new_tables(i.before, n=4, seq=0)
    names = ("order_doc", "late_doc", "kept_doc")
    sources = {n: DocSource(n, ORDER_DOC.query, ORDER_DOC.tables, ORDER_DOC.parts) for n in names}
    targets = {"order_doc": [first, second], "late_doc": [stale], "kept_doc": [kept]}
    second.set_position(1)
    stale.rebuild(ORDER_DOC.documents(i.spark, i.before).drop("suppliers"), "order_id", ORDER_DOC.parts, seq=0)
    kept.set_position(7)
    job = SyncJob(sources, RULES, targets)
    plan = recovery_plan(i.spark, job, i.after)
    why = {r["index"]: (r["action"], r["reason"]) for r in plan.collect()}  # one row for each index
    recover(i.spark, job, i.after, RebuildLog(i.spark, new_dir(i.spark, "log")), plan, seq=9)
    out = [
        t.read().select(
            F.lit(n).alias("index"), F.lit(k).alias("replica"), F.lit(why[n][0]).alias("action"),
            F.lit(why[n][1]).alias("reason"), F.lit(t.current().seq).alias("seq"), "*",
        )
        for n, tables in targets.items()
        for k, t in enumerate(tables)
    ]
    return reduce(DataFrame.unionByName, out)


QUERIES["recovery_plan"] = QUERIES.pop("recovery")


@query
def part_status(i: Inputs) -> DataFrame:
    tables = i.new_tables(i.before)
    sync_batch(i.spark, i.job(tables), i.after, i.feeds, batch_id=1, seq=1)
    return maintenance.part_status(tables[0]).select(
        "part", "n_docs", (F.col("n_files") >= 2).alias("has_files"), (F.col("base_bytes") > 0).alias("has_base"),
        (F.col("delta_bytes") > 0).alias("has_delta"),
    )


@query
def compaction_candidates(i: Inputs) -> DataFrame:
    tables = i.new_tables(i.before)
    sync_batch(i.spark, i.job(tables), i.after, i.feeds, batch_id=1, seq=1)
    t = tables[0]
    over = maintenance.compaction_candidates(t, 1).select("part", F.lit(True).alias("over"))
    off = maintenance.compaction_candidates(t, 0).count()
    over = i.spark.createDataFrame(over.collect(), over.schema)  # one row per part, before compacting
    maintenance.compact_if_needed(t, 1)
    return maintenance.part_status(t).join(F.broadcast(over), "part", "left").select(
        "part", "n_docs", "over", F.lit(off).alias("n_when_off"), "delta_bytes"
    )


@query
def sync_status(i: Inputs) -> DataFrame:
    a, b = i.new_tables(i.before, n=2, seq=0)
    half = _max(i.orders_flat, "seq") // 2
    sync_batch(i.spark, i.job([a]), i.after, i.feeds, batch_id=1, seq=half)
    last = _max(i.orders_feed.df, F.unix_micros(F.col("ts").cast("timestamp")))
    now = F.timestamp_micros(F.lit(last + 90_000_000))
    return status_of(i.spark, {"a": a, "b": b}, [i.orders_feed], now)
