"""Document sources: one Spark SQL query with typed aliases per document table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.coerce import COLUMN_TYPES, IN_PLACE_TYPES, part_of, typed
from docloom.operators.restrict import bit_words, possible


# Names the stored table uses itself, as well as all that begin with an underscore.
RESERVED = ("doc_version", "doc_write", "doc_part")


class SourceError(ValueError):
    """The document query does not declare usable typed columns."""


def split_alias(alias: str) -> tuple[str, str]:
    """`name:type` -> (name, type)."""
    name, colon, doc_type = alias.partition(":")
    if not colon or not doc_type or ":" in doc_type:
        raise SourceError(f"query column {alias!r} needs an alias of the form name:type")
    if not name:
        raise SourceError(f"query column {alias!r} needs a name before the colon, as it is not a plain column")
    if name.startswith("_") or name in RESERVED:
        raise SourceError(f"query column {name!r} has a reserved name")
    if doc_type not in COLUMN_TYPES:
        raise SourceError(f"query column {alias!r} has the unknown type {doc_type!r}")
    return name, doc_type


def bare_columns(df: DataFrame) -> list[str | None]:
    """For each output column of a query, the table column it is an alias of, or None for any other expression.

    Read off the plan Spark has analysed, at the place where the alias is given.
    """
    plan = df._jdf.queryExecution().analyzed()
    output = plan.output()
    wanted = [output.apply(k).exprId().id() for k in range(output.size())]
    found: dict[int, str | None] = {}
    while True:
        kind = plan.nodeName()
        if kind in ("Project", "Aggregate"):
            listed = plan.projectList() if kind == "Project" else plan.aggregateExpressions()
            for k in range(listed.size()):
                e = listed.apply(k)
                if e.nodeName() == "Alias":
                    child = e.child()
                    name = child.name() if child.nodeName() == "AttributeReference" else None
                    found.setdefault(e.exprId().id(), name)
        if plan.children().size() != 1:
            return [found.get(i) for i in wanted]
        plan = plan.children().apply(0)


def with_names(df: DataFrame) -> DataFrame:
    """The query's result with `:type` aliases of bare columns completed to `column:type`."""
    if not any(c.startswith(":") for c in df.columns):
        return df
    return df.toDF(*[(b or "") + c if c.startswith(":") else c for c, b in zip(df.columns, bare_columns(df))])


def declared_columns(aliases: Iterable[str]) -> dict[str, str]:
    """Name -> type for a query's output columns, with exactly one id and no name twice."""
    columns: dict[str, str] = {}
    for alias in aliases:
        name, doc_type = split_alias(alias)
        if name in columns:
            raise SourceError(f"query column {name!r} is declared twice")
        columns[name] = doc_type
    ids = [name for name, doc_type in columns.items() if doc_type == "id"]
    if len(ids) != 1:
        raise SourceError(f"a query needs exactly one column of type id, found {ids or 'none'}")
    return columns


@dataclass(frozen=True)
class DocSource:
    """A document table's definition.

    `query` names its base tables as `{table}` placeholders; `tables` maps each of them to the column that holds
    the document id there, or to None for lookup tables.  That column lets a refresh of a few documents cut the
    base tables down before the query joins and groups them.

    The stored table has one row per document.  If the query may give several, `latest` is the SQL expression over
    the document columns by which the last one is taken; without it, writing such a document fails.
    """

    name: str
    query: str
    tables: Mapping[str, str | None]
    parts: int = 1
    latest: str | None = None
    _columns: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        if self.parts < 1:
            raise SourceError(f"{self.name}: parts must be at least 1")
        if not any(self.tables.values()):
            raise SourceError(f"{self.name}: at least one table must hold the document id")

    def raw(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
        """The query as written, columns called `name:type`."""
        missing = [t for t in self.tables if t not in frames]
        if missing:
            raise SourceError(f"{self.name}: no data for tables {missing}")
        return with_names(spark.sql(self.query, **{t: frames[t] for t in self.tables}))

    def columns(self, raw: DataFrame) -> dict[str, str]:
        return declared_columns(raw.columns)

    def documents(
        self, spark: SparkSession, frames: Mapping[str, DataFrame], ids: DataFrame | None = None
    ) -> DataFrame:
        """Typed documents; with `ids` (one column `doc_id`), only those documents.

        Every base table that holds the document id is cut down by the ids' bits below the query's own joins and
        aggregates, where its rows were read; the documents are then cut down exactly.
        """
        if ids is not None:
            words = bit_words(ids)
            frames = {t: possible(frames[t], key, words) if key else frames[t] for t, key in self.tables.items()}
        raw = self.raw(spark, frames)
        dtypes = {f.name: f.dataType for f in raw.schema.fields}
        if ids is not None:
            (key,) = (f"{n}:{t}" for n, t in self.columns(raw).items() if t == "id")
            wanted = ids.select(F.col("doc_id").alias("_wanted")).distinct()
            raw = raw.join(wanted, F.col(f"`{key}`") == F.col("_wanted")).drop("_wanted")

        def column(name: str, doc_type: str):
            c, dtype = F.col(f"`{name}:{doc_type}`"), dtypes[f"{name}:{doc_type}"]
            if doc_type == "id" and ids is not None and isinstance(dtype, T.IntegralType):
                # it matched a valid id already; left as a plain column, it keeps the partitioning of the query's joins
                return c.cast("bigint")
            return typed(c, dtype, doc_type)

        return raw.select(*[column(n, t).alias(n) for n, t in self.columns(raw).items()])

    def single(self, spark: SparkSession, frames: Mapping[str, DataFrame], docs: DataFrame) -> DataFrame:
        """`docs` with one row per document, as the stored table needs it."""
        key = self.id_column(spark, frames)
        if self.latest is not None:
            return latest_per_document(docs, key, F.expr(self.latest))
        others = [c for c in docs.columns if c != key]
        text = F.concat(F.lit(f"{self.name}: the query gives several rows for document "), F.col("_id").cast("string"))
        # a filter leaves the id a plain column, which keeps the partitioning of the query's joins
        once = F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
        # `first` of plain columns is an ordinary aggregate, without a struct to compare
        held = docs.groupBy(F.col(key).alias("_id")).agg(
            F.count("*").alias("_n"), *[F.first(f"`{c}`").alias(c) for c in others]
        )
        return held.where(once).select(*[F.col("_id").alias(key) if c == key else F.col(f"`{c}`") for c in docs.columns])

    def part_documents(self, spark: SparkSession, frames: Mapping[str, DataFrame], part: int) -> DataFrame:
        """Documents of one partition; the base tables are filtered before the query runs."""
        if not 0 <= part < self.parts:
            raise SourceError(f"{self.name} has no partition {part}")
        if self.parts == 1:
            return self.documents(spark, frames)
        cut = {
            t: frames[t].where(part_of(F.col(key), self.parts) == part) if key else frames[t]
            for t, key in self.tables.items()
        }
        return self.documents(spark, cut)

    def schema(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> T.StructType:
        return self.documents(spark, frames).schema

    def types(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> dict[str, str]:
        """Declared column types; they depend on the query text only, so they are looked up once."""
        if not self._columns:
            self._columns.update(self.columns(self.raw(spark, frames)))
        return dict(self._columns)

    def id_column(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> str:
        return next(n for n, t in self.types(spark, frames).items() if t == "id")

    def in_place_columns(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> list[str]:
        """Attributes that can change without replacing the document."""
        return [n for n, t in self.types(spark, frames).items() if t in IN_PLACE_TYPES]


def latest_per_document(docs: DataFrame, id_column: str, order) -> DataFrame:
    """One row per document id, the last one by `order`."""
    row = F.max_by(F.struct(*docs.columns), order).alias("_row")
    return docs.groupBy(F.col(id_column).alias("_id")).agg(row).select("_row.*")
