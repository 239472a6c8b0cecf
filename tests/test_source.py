"""Typed aliases, restriction of documents, and type coercion."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import coerce
from docloom.operators.source import DocSource, SourceError, declared_columns, latest_per_document


def test_declared_columns():
    """Any choice of types with one id, in any order."""
    rng = random.Random(1)
    others = [t for t in coerce.COLUMN_TYPES if t != "id"]
    for _ in range(50):
        types = [rng.choice(others) for _ in range(rng.randrange(6))]
        types.insert(rng.randrange(len(types) + 1), "id")
        want = {f"col{n}": t for n, t in enumerate(types)}
        assert declared_columns(f"{n}:{t}" for n, t in want.items()) == want
        spoilt = [f"{n}:{t}" for n, t in want.items()]
        at = rng.randrange(len(spoilt))
        name, kind = spoilt[at].split(":")
        for bad, message in (
            (name, "form name:type"),
            (f"{name}:", "form name:type"),
            (f"{name}:{kind}:{kind}", "form name:type"),
            (f":{kind}", "needs a name"),
            (f"_{name}:{kind}", "reserved name"),
            (f"doc_part:{kind}", "reserved name"),
            (f"doc_write:{kind}", "reserved name"),
            (f"{name}:{kind}_", f"unknown type '{kind}_'"),
        ):
            with pytest.raises(SourceError, match=message):
                declared_columns([*spoilt[:at], bad, *spoilt[at + 1 :]])
        with pytest.raises(SourceError, match="declared twice"):
            declared_columns([*spoilt, spoilt[at]])
        with pytest.raises(SourceError, match="exactly one column of type id"):
            declared_columns([*spoilt, "another:id"])
        with pytest.raises(SourceError, match="exactly one column of type id"):
            declared_columns([x for x in spoilt if not x.endswith(":id")])


def test_query_text_errors(spark):
    frames = {"t": spark.createDataFrame([(1, 2)], "k bigint, v bigint")}
    for text in ("SELECT FROM WHERE", "SELECT t.missing AS `id:id` FROM {t} t"):
        with pytest.raises(Exception):
            DocSource("d", text, {"t": "k"}).documents(spark, frames)
    with pytest.raises(SourceError, match="no data for tables"):
        DocSource("d", "SELECT t.k AS `id:id` FROM {t} t", {"t": "k"}).documents(spark, {})
    with pytest.raises(SourceError, match="at least one table"):
        DocSource("d", "SELECT 1 AS `id:id`", {"test": None})


def test_short_aliases_take_the_column_name(spark):
    frames = {"t": spark.createDataFrame([(1, 2, 3, "x"), (1, 2, 3, "y")], "k bigint, lo int, hi int, s string")}
    plain = DocSource(
        "d", "SELECT t.k `:id`, t.lo AS `:attr_uint`, hi AS `:attr_uint`, upper(t.s) AS `s:field` FROM {t} t", {"t": "k"}
    )
    assert plain.types(spark, frames) == {"k": "id", "lo": "attr_uint", "hi": "attr_uint", "s": "field"}
    assert sorted(map(tuple, plain.documents(spark, frames).collect())) == [(1, 2, 3, "X"), (1, 2, 3, "Y")]
    grouped = DocSource(
        "d",
        """SELECT t.k AS `:id`, min(t.s) AS `s:field`, t.lo `:attr_uint`
           FROM {t} t GROUP BY t.k, t.lo HAVING count(*) > 1 ORDER BY 1""",
        {"t": "k"},
    )
    ids = spark.createDataFrame([(1,)], "doc_id bigint")
    assert list(map(tuple, grouped.documents(spark, frames, ids=ids).collect())) == [(1, "x", 2)]
    for text in ("SELECT t.k + 1 AS `:id` FROM {t} t", "SELECT t.k AS `:id`, lower(t.s) AS `:field` FROM {t} t"):
        with pytest.raises(SourceError, match="needs a name before the colon"):
            DocSource("d", text, {"t": "k"}).documents(spark, frames)


def test_documents_and_parts(spark):
    frames = {
        "t": spark.range(10).withColumnRenamed("id", "k"),
        "c": spark.range(40).select((F.col("id") % 8).alias("k"), F.col("id").alias("v")),
    }
    source = DocSource(
        "d",
        """SELECT t.k AS `id:id`, c.vs AS `vs:attr_multi` FROM {t} t
           LEFT JOIN (SELECT k, collect_set(v) AS vs FROM {c} GROUP BY k) c ON c.k = t.k""",
        {"t": "k", "c": "k"},
        parts=3,
    )
    everything = {r["id"]: r["vs"] for r in source.documents(spark, frames).collect()}
    assert everything[3] == [3, 11, 19, 27, 35] and everything[9] == []
    ids = spark.createDataFrame([(3,), (9,), (77,)], "doc_id bigint")
    some = {r["id"]: r["vs"] for r in source.documents(spark, frames, ids=ids).collect()}
    assert some == {k: everything[k] for k in (3, 9)}
    for k in range(3):
        part = {r["id"]: r["vs"] for r in source.part_documents(spark, frames, k).collect()}
        assert part == {i: v for i, v in everything.items() if i % 3 == k}
    with pytest.raises(SourceError, match="no partition 3"):
        source.part_documents(spark, frames, 3)


def test_restriction_reaches_the_children_below_the_aggregate(spark, sf_dir):
    """The ids cut every table that holds them before it is grouped, and joins read only the needed columns."""
    from docloom.workload.inputs import Inputs
    from docloom.workload.orders import ORDER_DOC

    i = Inputs(spark, sf_dir)
    ids = spark.createDataFrame([(1,)], "doc_id bigint")
    docs = ORDER_DOC.documents(spark, i.frames, ids=ids)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2
    aggregate = plan.index("Aggregate [l_orderkey")
    assert "LeftSemi" in plan[aggregate:]
    physical = docs._jdf.queryExecution().toString()
    assert "l_extendedprice" not in physical.split("Physical Plan")[1]


def test_latest_per_document(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "id bigint, n int, v string")
    got = {r["id"]: r["v"] for r in latest_per_document(df, "id", F.col("n")).collect()}
    assert got == {1: "c", 2: "z"}


def typed_values(spark, kind, doc_type, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    c = coerce.typed(F.col("v"), df.schema["v"].dataType, doc_type)
    return [r["v"] for r in df.select("n", c.alias("v")).orderBy("n").collect()]


@pytest.mark.parametrize(
    "kind,doc_type,values,want",
    [
        ("bigint", "attr_uint", [0, 7, -1, 4294967296 + 5, None], [0, 7, 4294967295, 5, 0]),
        ("double", "attr_uint", [2.9, -1.5], [2, 4294967295]),
        ("string", "attr_uint", ["0", "4294967295", None], [0, 4294967295, 0]),
        ("binary", "attr_uint", [bytearray(b"12")], [12]),
        ("string", "attr_bigint", ["-9223372036854775808", "+5", None], [-9223372036854775808, 5, 0]),
        ("string", "id", ["17", None], [17, 0]),
        ("double", "attr_float", [1.23456789, None], [1.234568, 0.0]),
        ("string", "field", ["a\x00b", None], ["ab", ""]),
        ("binary", "attr_string", [bytearray("é\x00".encode())], ["é"]),
        ("bigint", "attr_string", [5], ["5"]),
        ("string", "attr_multi", ["3,1,3", "", None, "5"], [[1, 3], [], [], [5]]),
        ("array<int>", "attr_multi_64", [[2, 1, 2], None], [[1, 2], []]),
    ],
)
def test_coercion(spark, kind, doc_type, values, want):
    assert typed_values(spark, kind, doc_type, values) == want


@pytest.mark.parametrize(
    "kind,doc_type,value",
    [
        ("string", "attr_uint", "4294967296"),
        ("string", "attr_uint", "-1"),
        ("string", "attr_uint", " 1"),
        ("string", "attr_uint", "1.5"),
        ("string", "attr_bigint", "9223372036854775808"),
        ("string", "attr_bigint", "x"),
        ("string", "attr_multi", "1,x"),
        ("string", "id", "-3"),
        ("bigint", "id", -3),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_refused_values(spark, kind, doc_type, value, ansi):
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a valid|negative document id"):
            typed_values(spark, kind, doc_type, [value])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_unknown_type(spark):
    with pytest.raises(ValueError, match="unknown document column type"):
        coerce.typed(F.lit(1), None, "text")


def test_one_row_check_keeps_the_partitioning(spark, sf_dir):
    """A join on the id after the check shuffles the documents no further."""
    from docloom.workload.inputs import Inputs
    from docloom.workload.orders import ORDER_DOC

    i = Inputs(spark, sf_dir)
    ids = i.frames["orders"].select(F.col("o_orderkey").alias("doc_id"))
    docs = ORDER_DOC.single(spark, i.frames, ORDER_DOC.documents(spark, i.frames, ids=ids))
    joined = ids.hint("merge").join(docs, F.col("doc_id") == F.col("order_id"), "left")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [doc_id" in plan
    assert "hashpartitioning(order_id#" not in plan and "hashpartitioning(_id#" not in plan
