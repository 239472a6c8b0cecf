"""Folding without sorting: plans, and values of every kind."""

import datetime
import random
from decimal import Decimal

import pytest

from docloom.operators.netchange import changed_attrs, changed_column_flags, changed_columns, net_changes, prune_unchanged
from docloom.operators.rules import IngestRule, TableFeed, apply_rule, change_number, change_order, route
from docloom.workload.inputs import Inputs
from docloom.workload.queries import QUERIES

KINDS = {
    "b": ("boolean", [True, False, None]),
    "i": ("int", [1, 2, None]),
    "f": ("double", [0.0, 1.5, float("nan"), None]),
    "d": ("decimal(30,4)", [Decimal("1.0000"), Decimal("12345678901234567890.5000"), None]),
    "s": ("string", ["", "a", "A", None]),
    "x": ("binary", [bytearray(b""), bytearray(b"a"), None]),
    "t": ("timestamp", [datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 1, 0, 0, 1), None]),
    "l": ("array<string>", [[], ["a"], ["a", None], None]),
    "z": ("struct<u: int, v: string>", [(1, "a"), (1, None), None]),
}


def history(seed, n_docs=60):
    """Rows of a keyed table that come, change and go, several to a document."""
    r = random.Random(seed)
    rows, live, seq = [], {}, 0
    for _ in range(n_docs * 8):
        key = r.randrange(n_docs * 3)
        seq += r.choice((1, 1, 3))
        image = (key, key // 3, *(r.choice(v) for _, v in KINDS.values()))
        if key not in live:
            rows.append((seq, "insert", None, image))
            live[key] = image
        elif r.random() < 0.4:
            rows.append((seq, "delete", live.pop(key), None))
        else:
            new = image if r.random() < 0.5 else live[key]
            rows.append((seq, "update", live[key], new))
            live[key] = new
    return rows


def feed(spark, rows, pk, row_no=False):
    image = "struct<k: bigint, doc: bigint, " + ", ".join(f"{c}: {t}" for c, (t, _) in KINDS.items()) + ">"
    df = spark.createDataFrame(
        [(s, s, datetime.datetime(2020, 1, 1), a, o, n) for s, a, o, n in rows],
        f"seq bigint, event_id bigint, ts timestamp, action string, old {image}, new {image}",
    )
    return TableFeed("t", df.selectExpr("*", "0 AS row_no") if row_no else df, pk)


@pytest.mark.parametrize("row_no,seed", [(False, 1), (True, 2)])
@pytest.mark.parametrize("id_field,pk", [("doc", ("k",)), ("k", ("k",)), ("doc", ())])
def test_values_tell_what_images_tell(spark, seed, row_no, id_field, pk):
    """Changed columns from values of fixed width against those of the images that `net_changes` keeps."""
    rule = IngestRule("t", id_field, "d", {c: (f"a_{c}",) for c in KINDS})
    r = apply_rule(feed(spark, history(seed), pk, row_no), rule)
    assert r.by_seq is not row_no
    docs = {}
    for n in prune_unchanged(net_changes(r)).collect():
        docs.setdefault(n["doc_id"], []).append(n)
    want = {}
    for doc, nets in docs.items():
        before = {repr(n["old"]) for n in nets if n["is_delete"] or n["is_update"]}
        after = {repr(n["new"]) for n in nets if n["is_insert"] or n["is_update"]}
        if before == after:
            continue
        if max(len(before), len(after)) > 1:
            want[doc] = set(KINDS)
        else:
            want[doc] = {c for n in nets for c in KINDS if repr(n["old"][c]) != repr(n["new"][c])}
    got = {x["doc_id"]: set(x["columns"]) for x in changed_columns(r).collect()}
    assert got == {d: c for d, c in want.items()} and got


def test_numbers_keep_the_order(spark):
    rows = [(s, r, n, b) for s in (0, 1, 2**61) for r in (0, 1, 300) for n in (0, 1, 2**31 - 1) for b in (0, 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "seq bigint, rule_id int, row_no int, sub_no int")
    any_r = apply_rule(feed(spark, history(1, 2), ("k",), True), IngestRule("t", "k", "d", {"s": ("x",)}))
    got = df.select("*", change_number(any_r).alias("n")).orderBy("n").drop("n").collect()
    assert got == df.orderBy(change_order()).collect()
    assert df.select(change_number(any_r).alias("n")).distinct().count() == len(rows)
    plain = apply_rule(feed(spark, history(1, 2), ("k",)), IngestRule("t", "k", "d", {"s": ("x",)}))
    with pytest.raises(Exception, match="(?i)overflow"):
        df.selectExpr(f"{2**62} AS seq", "sub_no").select(change_number(plain)).collect()


def test_nothing_is_sorted(spark, sf_dir):
    """Changed attributes come from hash aggregates alone."""
    i = Inputs(spark, sf_dir)
    for df in (changed_attrs(i.routed), changed_column_flags(i.routed[1]), QUERIES["changed_attrs"](spark, sf_dir)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan
        assert "SortAggregate" not in plan and "Sort [" not in plan and "ObjectHashAggregate" not in plan


def test_rules_that_share_a_table_keep_their_order(spark):
    rules = [IngestRule("t", "doc", "d", {"s": ("x",)}), IngestRule("t", "k", "d", {"s": ("x",)})]
    rows = [(1, "insert", None, (5, 7, *[None] * 4, "a", *[None] * 4)), (2, "update", (5, 7, *[None] * 4, "a", *[None] * 4), (5, 7, *[None] * 4, "b", *[None] * 4))]
    (r,) = route([feed(spark, rows, ("k",))], rules)
    assert not r.by_seq
    assert {x["doc_id"] for x in changed_attrs([r]).collect()} == {5, 7}
