"""Routing row events to documents."""

import datetime
import random
from collections import Counter

import pytest

from docloom.operators.rules import IngestRule, RuleError, TableFeed, apply_rule, check_rules, match_rules, route
from docloom.operators.source import DocSource
from docloom.sources.feed import flatten_rows, logical_rows

RULE = IngestRule("stock", "doc", "idx", {"amount": ()})
NOW = datetime.datetime(2024, 3, 5, 7, 9, 11)
ROW = "struct<doc: bigint, amount: bigint, note: string>"


def events(spark, *evs, row=ROW):
    """(table, action, rows) as raw multi-row events."""
    data = [(n, n, NOW, t, a, list(rows)) for n, (t, a, rows) in enumerate(evs)]
    return spark.createDataFrame(
        data, f"seq bigint, event_id bigint, ts timestamp, table string, action string, rows array<{row}>"
    )


def generated(seed, n):
    """Events of two tables with one to four logical rows each."""
    rng = random.Random(seed)
    row = lambda: (rng.choice([None, 1, 2, 3, 4]), rng.randrange(9), rng.choice("uvw"))
    out = []
    for _ in range(n):
        table, action = rng.choice(["stock", "other"]), rng.choice(["insert", "update", "delete"])
        out.append((table, action, [row() for _ in range(rng.randrange(0, 5) * (2 if action == "update" else 1))]))
    return out


def expected(evs, pk):
    """Changes of `stock` one by one: (seq, action, document, key, old amount, new amount)."""
    names = ("doc", "amount", "note")
    key = lambda r: tuple(r[names.index(c)] for c in pk or names)
    out = []
    for n, (table, action, rows) in enumerate(evs):
        if table != "stock":
            continue
        pairs = zip(rows[::2], rows[1::2]) if action == "update" else ((r, r) for r in rows)
        for old, new in pairs:
            if action == "insert":
                out.append((n, action, new[0] or 0, key(new), None, new[1]))
            elif action == "delete":
                out.append((n, action, old[0] or 0, key(old), old[1], None))
            elif new[0] is None or new[0] == (old[0] or 0):
                out.append((n, action, old[0] or 0, key(old), old[1], new[1]))
            else:  # the row moves to another document
                out.append((n, "delete", old[0] or 0, key(old), old[1], None))
                out.append((n, "insert", new[0], key(new), None, new[1]))
    return out


@pytest.mark.parametrize("pk", [("doc",), ("note",), ("note", "doc"), ()])
def test_routing_of_generated_events(spark, pk):
    evs = generated(len(pk), 300)
    raw = events(spark, *evs)
    feed = TableFeed("stock", flatten_rows(raw.where("table = 'stock'")), pk)
    (r,) = route([feed], [RULE])
    got = [
        (c["seq"], c["action"], c["doc_id"], tuple(c["pk"]), c["old"]["amount"], c["new"]["amount"])
        for c in r.df.orderBy("seq", "rule_id", "row_no", "sub_no").collect()
    ]
    assert got == expected(evs, pk)
    assert r.one_row == (pk == ("doc",))
    other = TableFeed("other", flatten_rows(raw.where("table = 'other'")), pk)
    assert route([other], [RULE]) == []
    assert sum(x["n"] for x in raw.select(logical_rows().alias("n")).collect()) == flatten_rows(raw).count()


def test_bytes_are_compared_as_text(spark):
    rule = IngestRule("stock", "doc", "idx", {"note": ()})
    raw = events(spark, ("stock", "insert", [(1, 2, bytearray(b"oak"))]), row=ROW.replace("note: string", "note: binary"))
    (r,) = route([TableFeed("stock", flatten_rows(raw), ("note",))], [rule])
    (c,) = r.df.collect()
    assert (c["pk"]["note"], c["new"]["note"]) == ("oak", "oak")


def test_each_rule_gets_the_events_of_its_table(spark):
    rules = [IngestRule(t, "doc", i, {"amount": ()}) for t in ("none", "other", "stock") for i in ("x", "y")]
    evs = generated(5, 80)
    raw = events(spark, *evs)
    feeds = [TableFeed(t, flatten_rows(raw.where(f"table = '{t}'")), ("doc",)) for t in ("stock", "other")]
    for order in (rules, rules[::-1]):
        got = {(r.table, r.index): r.df.select("seq").distinct().count() for r in route(feeds, order)}
        seen = Counter(t for t, _, rows in evs if rows)
        assert got == {(t, i): seen[t] for t in seen for i in ("x", "y")}
        matched = Counter((m["table"], m["index"]) for m in match_rules(raw, order).collect())
        assert matched == {(t, i): n for t, n in Counter(t for t, _, _ in evs).items() for i in ("x", "y")}


def test_rules_of_one_shape_share_documents(spark):
    rules = [IngestRule("t", "a", "i", {"v": ("x",)}), IngestRule("t", "b", "i", {"v": ("x",)})]
    raw = events(spark, ("t", "insert", [(1, 2, 3)]), row="struct<a: bigint, b: bigint, v: bigint>")
    (r,) = route([TableFeed("t", flatten_rows(raw), ("a",))], rules)
    assert sorted(c["doc_id"] for c in r.df.collect()) == [1, 2]
    assert not r.one_row


def test_errors(spark):
    feed = TableFeed("stock", flatten_rows(events(spark, ("stock", "insert", [(1, 5, "u")]))), ("doc",))
    with pytest.raises(RuleError, match="no column 'nope'"):
        apply_rule(feed, IngestRule("stock", "nope", "idx", {"amount": ()}))
    with pytest.raises(RuleError, match="maps none"):
        apply_rule(feed, IngestRule("stock", "doc", "idx", {"other": ()}))
    bad = TableFeed("stock", flatten_rows(events(spark, ("stock", "insert", [(-4, 1, "x")]))), ("doc",))
    with pytest.raises(Exception, match="negative document id"):
        apply_rule(bad, RULE).df.collect()
    odd = TableFeed("stock", flatten_rows(events(spark, ("stock", "insert", [(1, 5, "u")]))).replace("insert", "upsert"), ("doc",))
    with pytest.raises(Exception, match="unknown row action"):
        apply_rule(odd, RULE).df.collect()


def test_rule_checks():
    source = DocSource("idx", "", {"t": "id"})
    columns = {"idx": ["id", "x"]}
    check_rules([IngestRule("t", "id", "idx", {"v": ("x",)})], {"idx": source}, columns)
    for rule, message in [
        (IngestRule("t", "id", "i2", {"v": ("x",)}), "no document source"),
        (IngestRule("u", "id", "idx", {"v": ("x",)}), "not part of the query"),
        (IngestRule("t", "id", "idx", {}), "maps no columns"),
        (IngestRule("t", "id", "idx", {"v": ("y",)}), "unknown columns"),
    ]:
        with pytest.raises(RuleError, match=message):
            check_rules([rule], {"idx": source}, columns)
