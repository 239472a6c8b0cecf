"""Change feeds: reading decoded row changes, flattening multi-row events, snapshots as changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.rules import TableFeed


def write_feed(feeds: Sequence[TableFeed], root: str) -> None:
    """Store feeds as Parquet, one folder `table=<name>` per table.

    Tables have different image types, so each folder is a data set of its own; reading a table never touches
    the others.
    """
    for f in feeds:
        f.df.write.mode("append").parquet(f"{root}/table={f.table}")


def read_feed(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, Sequence[str]],
    schemas: Mapping[str, T.StructType] | None = None,
) -> list[TableFeed]:
    """Feeds of the named tables (name -> primary key columns); only their folders are listed and read.

    Known schemas spare opening files to find them.
    """
    out = []
    for t, pk in tables.items():
        reader = spark.read.schema(schemas[t]) if schemas and t in schemas else spark.read
        out.append(TableFeed(t, reader.parquet(f"{root}/table={t}"), tuple(pk)))
    return out


def stream_feed(
    spark: SparkSession, root: str, table: str, schema: T.StructType, pk: Sequence[str] = (), **options
) -> TableFeed:
    """The same feed as a stream of files."""
    reader = spark.readStream.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return TableFeed(table, reader.parquet(f"{root}/table={table}"), tuple(pk))


def logical_rows() -> Column:
    """Number of row changes in an event; updates hold an old and a new image per row."""
    n = F.size("rows")
    return F.when(F.col("action") == "update", F.floor(n / 2)).otherwise(n).cast("bigint")


def flatten_rows(events: DataFrame) -> DataFrame:
    """Multi-row events (`seq, ..., action, rows`) as one row per change with `row_no, old, new`.

    In updates, rows alternate between the old and the new image.
    """
    row_type = events.schema["rows"].dataType.elementType
    none = F.lit(None).cast(row_type)
    n = logical_rows().cast("int")
    numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def pick(i: Column) -> Column:
        rows = F.col("rows")
        old = F.when(F.col("action") == "update", F.get(rows, i * 2)).when(
            F.col("action") == "delete", F.get(rows, i)
        ).otherwise(none)
        new = F.when(F.col("action") == "update", F.get(rows, i * 2 + 1)).when(
            F.col("action") == "insert", F.get(rows, i)
        ).otherwise(none)
        return F.struct(i.alias("row_no"), old.alias("old"), new.alias("new"))

    return events.select(
        *[c for c in events.columns if c != "rows"], F.inline(F.transform(numbers, pick))
    )


def snapshot_as_inserts(
    table: str, rows: DataFrame, seq: Column, event_id: Column, ts: Column, pk: Sequence[str] = ()
) -> TableFeed:
    """A table's current rows as a feed of inserts."""
    row = F.struct(*rows.columns)
    df = rows.select(
        seq.cast("bigint").alias("seq"),
        event_id.cast("bigint").alias("event_id"),
        ts.alias("ts"),
        F.lit("insert").alias("action"),
        F.lit(None).cast(rows.schema).alias("old"),
        row.alias("new"),
    )
    return TableFeed(table, df, tuple(pk))


def feed_from_flat(table: str, flat: DataFrame, columns: Sequence[str], pk: Sequence[str] = ()) -> TableFeed:
    """A feed whose images are flat `old_*` and `new_*` columns."""
    def side(name: str) -> Column:
        return F.struct(*[F.col(f"{name}_{c}").alias(c) for c in columns])

    df = flat.select("seq", "event_id", "ts", "action", side("old").alias("old"), side("new").alias("new"))
    return TableFeed(table, df, tuple(pk))
