"""Registered queries against their SQL on DuckDB; `check.py` runs all of them."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from docloom.workload.oracle import ORACLE
from docloom.workload.queries import QUERIES

QUICK = (
    "snapshot_as_inserts", "flatten_rows", "doc_move_split", "column_prune", "pk_fallback", "doc_query_full",
    "coerce_types", "net_row_change", "changed_attrs", "decide_action", "apply_changes", "settle_batches",
    "net_set_value", "event_tagging", "stream_apply",
)


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_same_result(spark, sf_dir, db, name):
    df = entry.queries()[name](spark, sf_dir)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    rel = db.sql(entry.oracle_sql()[name])
    want = pd.DataFrame(rel.fetchall(), columns=rel.columns, dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert normal(got) == normal(want)
