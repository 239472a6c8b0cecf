"""All rules of a table in one pass, and the counters that a follower stores."""

from collections import Counter

from docloom.operators.rules import IngestRule, TableFeed, fan_out, route, touched, touched_by
from docloom.session import new_dir
from docloom.sources.feed import flatten_rows, read_feed, write_feed

from test_rules import events, generated
from test_streaming import Setup, base, feed

RULES = [
    IngestRule("stock", "doc", "x", {"amount": ("a",)}),
    IngestRule("stock", "amount", "y", {"note": ("b",)}),
    IngestRule("stock", "amount", "x", {"amount": ("a",)}),
    IngestRule("other", "doc", "x", {"amount": ("a",)}),
]


def feeds_of(spark, seed):
    raw = events(spark, *generated(seed, 60))
    return [TableFeed(t, flatten_rows(raw.where(f"table = '{t}'")), ("doc",)) for t in ("stock", "other")]


def test_one_pass_gives_what_rules_give_one_by_one(spark):
    for seed in (1, 2):
        feeds = feeds_of(spark, seed)
        columns = ["index", "table", "seq", "rule_id", "row_no", "sub_no", "action", "doc_id"]
        one_by_one = touched([r for i, rule in enumerate(RULES) for f in feeds if f.table == rule.table
                              for r in route([f], [*[IngestRule("-", "", "", {})] * i, rule])])
        want = Counter(map(tuple, one_by_one.select(columns).collect()))
        assert Counter(map(tuple, touched_by(feeds, RULES).select(columns).collect())) == want
        assert Counter(map(tuple, touched(route(feeds, RULES)).select(columns).collect())) == want
        leads = touched_by(feeds, RULES).where("lead").groupBy("table").count().collect()
        assert dict(map(tuple, leads)) == {f.table: f.df.count() for f in feeds}


def scans(df):
    return str(df._jdf.queryExecution().executedPlan()).count("FileScan parquet")


def test_a_feed_is_scanned_once_for_all_its_rules(spark):
    root = new_dir(spark, "feed")
    write_feed([f for f in feeds_of(spark, 3) if f.table == "stock"], root)
    stored = read_feed(spark, root, {"stock": ["doc"]})
    assert scans(touched_by(stored, RULES)) == 1
    assert scans(touched(route(stored, RULES))) == 2  # a pass for each column map, whose images differ
    plan = str(touched_by(stored, RULES[:1])._jdf.queryExecution().executedPlan())
    assert "old:struct<doc:bigint>" in plan  # images stay in the file


def test_rules_that_match_nothing(spark):
    feed, _ = feeds_of(spark, 4)
    none = feed.df.where("false")
    assert fan_out(TableFeed("stock", none, ("doc",)), {0: RULES[0], 1: RULES[1]}).count() == 0


def test_stored_counters_equal_a_recount(spark):
    s = Setup(spark, base(spark, (1, 1, "a"), (2, 2, "b")), high_water=lambda: {"t": 9})
    s.frames = base(spark, (1, 5, "a"), (3, 3, "c"))
    first = [(1, "update", (1, 1, "a"), (1, 5, "a")), (2, "delete", (2, 2, "b"), None)]
    then = [(3, "insert", None, (3, 3, "c")), (4, "update", (1, 5, "a"), (4, 5, "a"))]
    f = s.follower()
    f.gap_seconds = f.hold_seconds = 0
    for rows in (first, then):
        write_feed([feed(spark, *rows)], s.root)
        f.start(heartbeat=False, trigger={"availableNow": True}).awaitTermination(120)
    got = dict(map(tuple, f.counters().collect()))
    assert got["row_events:t:update"] == 2 and got["row_events:t:delete"] == 1 and got["row_events:t:insert"] == 1
    # the second update moves the row: a delete and an insert
    assert got["doc_events:t:update"] == 1 and got["doc_events:t:delete"] == 2 and got["doc_events:t:insert"] == 2
    assert {c: n for c, n in got.items() if c.startswith("docs:")} == {"docs:d:update": 1, "docs:d:delete": 2, "docs:d:replace": 2}
    before = got
    f._sync(spark.createDataFrame([], "index string, table string, action string, doc_id bigint, seq bigint, event_id bigint, event_action string, lead boolean"), 1)
    assert dict(map(tuple, f.counters().collect())) == before  # a repeated batch counts once
