"""Re-reading a few documents: exact, and without a task for a document however many rows it has."""

import pytest
from pyspark.sql import functions as F

from docloom.operators import restrict
from docloom.operators.restrict import bit_words, possible
from docloom.operators.source import DocSource

SOURCE = DocSource(
    "d",
    """SELECT p.k AS `id:id`, coalesce(c.n, 0) AS `n:attr_uint`, c.tags AS `tags:attr_multi`
       FROM {parent} p LEFT JOIN (SELECT k, count(*) AS n, collect_set(tag) AS tags FROM {child} GROUP BY k) c ON c.k = p.k""",
    {"parent": "k", "child": "k"},
)


@pytest.fixture
def tables(spark):
    """Document 7 owns half of 200,000 child rows; some documents have none."""
    child = spark.range(200_000, numPartitions=16).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 5000).cast("bigint").alias("k"), (F.col("id") % 9).alias("tag")
    )
    return {"parent": spark.range(6000).withColumnRenamed("id", "k"), "child": child}


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in old.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def rows_of_tasks(spark, action):
    """Rows that each task read from a shuffle while `action` ran, by stage."""
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark._jvm

    def stages():
        found = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {found.apply(i).stageId(): found.apply(i) for i in range(found.size())}

    before = set(stages())
    action()
    out = {}
    for stage in set(stages()) - before:
        tasks = store.taskList(stage, 0, 10_000)
        metrics = [tasks.apply(i).taskMetrics() for i in range(tasks.size())]
        out[stage] = [m.get().shuffleReadMetrics().recordsRead() for m in metrics if m.isDefined()]
    return out


def got(df):
    return sorted((r["id"], r["n"], tuple(sorted(r["tags"] or ()))) for r in df.collect())


@pytest.mark.parametrize("bits", [6, 8, 25])
def test_only_the_wanted_documents(spark, tables, bits, monkeypatch):
    """Also with a bit table in which most bits are set."""
    monkeypatch.setattr(restrict, "BITS", bits)
    wanted = [0, 7, 8, 4999, 5500, 9999, *range(100, 140)]
    ids = spark.createDataFrame([(i,) for i in wanted] + [(7,)], "doc_id bigint")
    full = {r[0]: r for r in got(SOURCE.documents(spark, tables))}
    assert got(SOURCE.documents(spark, tables, ids)) == [full[i] for i in sorted(set(wanted)) if i in full]
    none = ids.where("doc_id < 0")
    assert got(SOURCE.documents(spark, tables, none)) == []


def test_bits_of_any_key_type(spark):
    ids = spark.createDataFrame([(3,), (2**40,)], "doc_id bigint")
    words = bit_words(ids)
    for kind in ("int", "decimal(20,0)", "string", "bigint"):
        rows = spark.createDataFrame([(3,), (4,), (None,)], "k bigint").select(F.col("k").cast(kind).alias("k"))
        assert [int(r["k"]) for r in possible(rows, "k", words).collect()] == [3]


def test_a_hot_document_is_no_task(spark, tables, no_broadcast):
    """With broadcasts by size off, child rows are combined where they are read: no task reads more than its share."""
    ids = spark.range(0, 6000, 3).withColumnRenamed("id", "doc_id").union(spark.createDataFrame([(7,)], "doc_id bigint"))
    docs = SOURCE.documents(spark, tables, ids)
    found = rows_of_tasks(spark, lambda: docs.write.format("noop").mode("overwrite").save())
    read = [n for ns in found.values() for n in ns]
    assert 0 < sum(read) < 60_000  # not the 100,000 rows of document 7
    for ns in found.values():
        busy = sorted(n for n in ns if n)
        assert not busy or busy[-1] <= 3 * busy[len(busy) // 2]
