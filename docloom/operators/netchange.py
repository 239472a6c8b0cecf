"""Net changes: fold row changes per key, drop those that change nothing, name the changed columns and attributes.

Every step is a mergeable aggregate.  Rows are combined before each shuffle where a document has many of them, so no task
ever holds a large group: one document or one key may own any share of the feed.

What changed is found without the images: each column travels as values of fixed width, itself or two hashes of 64 bits,
under an order that is one number, so folding is a hash aggregate and nothing is sorted.  `net_changes` gives the images
themselves, which costs a sort by key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import flags
from docloom.operators.pending import changes_of
from docloom.operators.rules import RoutedChanges, change_number, change_order


def net_changes(r: RoutedChanges) -> DataFrame:
    """One row per (document, key): first old image, last new image and the net action.

    With `first` and `last` the actions at both ends and n the deletes in between, the outcome of applying the
    actions one by one is: an insert if it began with one and n is 0; a delete if it ended with one, unless that
    delete only took back the initial insert; an update otherwise.
    """
    order = change_order()
    # index and table are constants here; keeping them out of the keys leaves the sort a numeric prefix
    keys = ["doc_id"] if r.one_row else ["doc_id", "pk"]
    folded = r.df.groupBy(*keys).agg(
        F.min_by(F.struct("action", "old", *(["pk"] if r.one_row else [])), order).alias("head"),
        F.max_by(F.struct("action", "new"), order).alias("tail"),
        F.count_if(F.col("action") == "delete").alias("n_del"),
    )
    first, last = F.col("head.action"), F.col("tail.action")
    is_insert = (first == "insert") & (F.col("n_del") == 0)
    is_delete = (last == "delete") & ~((first == "insert") & (F.col("n_del") == 1))
    return folded.select(
        F.lit(r.index).alias("index"),
        F.lit(r.table).alias("table"),
        "doc_id",
        F.col("head.pk").alias("pk") if r.one_row else F.col("pk"),
        is_insert.alias("is_insert"),
        (~is_insert & ~is_delete).alias("is_update"),
        is_delete.alias("is_delete"),
        F.col("head.old").alias("old"),
        F.col("tail.new").alias("new"),
    )


def prune_unchanged(net: DataFrame) -> DataFrame:
    """Net changes whose images differ."""
    return net.where(~F.col("old").eqNullSafe(F.col("new")))


def _word_names(prefix: str, names: Sequence[str]) -> list[str]:
    return [f"{prefix}{i}" for i in range(flags.word_count(len(names)))]


def _values(side: str, f: T.StructField) -> list[Column]:
    """The column's value on one side in fixed width: itself, or 128 bits of hashes where that varies."""
    c, kind = F.col(f"{side}.`{f.name}`"), f.dataType
    if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return [c]
    return [F.when(c.isNotNull(), F.xxhash64(*salt, c)) for salt in ((), (F.lit("second"),))]


#: Row actions as numbers.
ACTIONS = {"insert": 0, "update": 1, "delete": 2}


#: A document with more row changes than this in one table is folded over several tasks.
HOT_ROWS = 100_000
#: Such documents are looked for in the crowded ones of so many classes of documents only.
CLASSES = 1 << 16


#: Key columns that two hashes tell apart; nested ones have nulls that a hash passes over.
FLAT = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BinaryType)


def _row_keys(r: RoutedChanges) -> dict[str, Column]:
    """What tells the rows of a document apart in `value_rows`: nothing, 128 bits of hashes of the row's key, or the key."""
    if r.one_row:
        return {}
    fields = r.df.schema["pk"].dataType.fields
    if not all(isinstance(f.dataType, FLAT) for f in fields):
        return {"pk": F.col("pk")}
    # a null is told from a value, and from the next column's, by its own hash
    cells = [c for f in fields for v in [F.col(f"pk.`{f.name}`")] for c in (v.isNull(), v)]
    return {f"pk{salt}": F.xxhash64(F.lit(salt), *cells) for salt in (0, 1)}


def value_rows(r: RoutedChanges, *more: str) -> tuple[DataFrame, dict[str, list[str]]]:
    """Row changes as values: `doc_id[, pk0, pk1], number, code, o0.., n0..` and `more` columns, and which of the numbers each
    column has."""
    parts: dict[str, list[str]] = {}
    old, new = [], []
    for f in r.df.schema["old"].dataType.fields:
        before, after = _values("old", f), _values("new", f)
        parts[f.name] = [str(len(old) + k) for k in range(len(before))]
        old, new = old + before, new + after
    code = reduce(lambda c, a: c.when(F.col("action") == a, F.lit(ACTIONS[a])), ACTIONS, F)
    rows = r.df.select(
        "doc_id",
        *[c.alias(k) for k, c in _row_keys(r).items()],
        change_number(r).alias("number"),
        code.alias("code"),
        *more,
        *[c.alias(f"o{i}") for i, c in enumerate(old)],
        *[c.alias(f"n{i}") for i, c in enumerate(new)],
    )
    return rows, parts


def folded_values(r: RoutedChanges, rows: DataFrame, count: int) -> DataFrame:
    """Net changes of `rows`, which have `count` values a side: `doc_id[, pk0, pk1], kind, o0.., n0..`."""
    keys = ["doc_id", *_row_keys(r)]
    folded = rows.groupBy(*keys).agg(
        F.min_by("code", "number").alias("first"),
        F.max_by("code", "number").alias("last"),
        # count_if would put aliases above the aggregate, and the optimizer's constraints double with each of them
        F.sum(F.when(F.col("code") == ACTIONS["delete"], 1).otherwise(0)).alias("n_del"),
        *[F.min_by(f"o{i}", "number").alias(f"o{i}") for i in range(count)],
        *[F.max_by(f"n{i}", "number").alias(f"n{i}") for i in range(count)],
    )
    # the rule of net_changes
    began = F.col("first") == ACTIONS["insert"]
    is_insert = began & (F.col("n_del") == 0)
    is_delete = (F.col("last") == ACTIONS["delete"]) & ~(began & (F.col("n_del") == 1))
    kind = F.when(is_insert, ACTIONS["insert"]).when(is_delete, ACTIONS["delete"]).otherwise(ACTIONS["update"])
    values = [f"{s}{i}" for s in "on" for i in range(count)]
    return folded.select(*keys, kind.alias("kind"), *values)


def changed_column_flags(r: RoutedChanges, within: DataFrame | None = None) -> DataFrame:
    """Per document, the flag words (`c0`, ...) of the table columns that changed; unchanged documents are absent.

    A document's rows in the table are compared as sets of images before and after: equal sets mean no change,
    whatever the keys.  If either set has more than one member every column counts as changed, otherwise those
    that differ.  The sets are never built: each distinct image is one group that remembers on which side it was
    seen, and the document counts its images per side and those seen on one side only.

    Row changes are dealt by document once, before anything is combined: most keys change once in a batch, so
    combining them where they are read only fills memory, and all groups lie within a document.  Rows travel without their
    keys, as hashes of them tell them apart.  Documents with
    more than `HOT_ROWS` changes, of which there are few, go another way, combined before each shuffle.

    `within`: only the row changes of these batches of the queue count.  They are picked where rows lie by document.
    """
    rows, parts = value_rows(r, *([] if within is None else ["seq"]))
    # a class has all rows of its documents, so only those of classes with as many rows are counted one by one
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(CLASSES))
    crowded = rows.groupBy(spot.alias("_class")).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS)
    several = rows.join(F.broadcast(crowded.select("_class")), spot == F.col("_class"), "left_semi")
    many = several.groupBy("doc_id").agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS)
    hot = F.broadcast(many.select(F.col("doc_id").alias("_hot")))
    is_hot = F.col("doc_id") == F.col("_hot")
    dealt, apart = rows.join(hot, is_hot, "left_anti").repartition("doc_id"), rows.join(hot, is_hot, "left_semi")
    if within is not None:
        dealt, apart = (changes_of(some, within, r.index).drop("seq") for some in (dealt, apart))
        apart = apart.hint("rebalance")  # else a hot document's rows would stay together where the join has put them
    return _flags(r, dealt, parts).unionByName(_flags(r, apart, parts))


def _flags(r: RoutedChanges, rows: DataFrame, parts: dict[str, list[str]]) -> DataFrame:
    """`changed_column_flags` of some documents' rows."""
    folded = folded_values(r, rows, sum(len(numbers) for numbers in parts.values()))
    words = _word_names("c", r.columns)
    differs = {
        c: reduce(lambda x, y: x | y, [~F.col(f"o{i}").eqNullSafe(F.col(f"n{i}")) for i in numbers])
        for c, numbers in parts.items()
    }
    masks = [m.alias(w) for m, w in zip(flags.pack(r.columns, differs), words)]
    # one condition on the words: a long disjunction takes the optimizer very long
    net = folded.select("*", *masks).where(reduce(lambda x, y: x | y, [F.col(w) != 0 for w in words]))
    names = [F.lit(r.index).alias("index"), F.lit(r.table).alias("table")]
    if r.one_row:
        # at most one image on each side, and they differ
        return net.select(*names, "doc_id", *words)

    numbers = [i for some in parts.values() for i in some]
    # a net delete or update has an image before (a = 0), a net insert or update one after (a = 1)
    sides = net.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("a"))
    has_image = F.col("kind") != F.when(F.col("a") == 0, ACTIONS["insert"]).otherwise(ACTIONS["delete"])
    image = [F.when(F.col("a") == 0, F.col(f"o{i}")).otherwise(F.col(f"n{i}")).alias(f"v{i}") for i in numbers]
    sides = sides.where(has_image).select("doc_id", *words, "a", (1 - F.col("a")).alias("b"), *image)
    images = sides.groupBy("doc_id", *[f"v{i}" for i in numbers]).agg(
        F.max("b").alias("b"), F.max("a").alias("a"), *[F.bit_or(w).alias(w) for w in words]
    )
    docs = images.groupBy("doc_id").agg(
        F.sum("b").alias("n_before"),
        F.sum("a").alias("n_after"),
        F.count_if(F.col("a") != F.col("b")).alias("n_one_sided"),
        *[F.bit_or(w).alias(w) for w in words],
    )
    many = (F.col("n_before") > 1) | (F.col("n_after") > 1)
    return docs.where(F.col("n_one_sided") > 0).select(
        *names,
        "doc_id",
        *[F.when(many, f).otherwise(F.col(w)).alias(w) for f, w in zip(flags.full(r.columns), words)],
    )


def changed_columns(r: RoutedChanges) -> DataFrame:
    """Per document, the names of the changed columns of one table."""
    words = [F.col(w) for w in _word_names("c", r.columns)]
    return changed_column_flags(r).select(
        "index", "table", "doc_id", flags.unpack(r.columns, words).alias("columns")
    )


def _index_attrs(branches: Sequence[RoutedChanges]) -> list[str]:
    return sorted({a for r in branches for c in r.columns for a in r.column_map.get(c, ())})


def changed_attrs(routed: Iterable[RoutedChanges], within: DataFrame | None = None) -> DataFrame:
    """Per (index, document), the document attributes whose inputs changed: `index, doc_id, attrs`.

    Documents that were touched without a net change, or only in columns that feed nothing, are absent; with `within`, so
    are row changes of no batch in it.
    """
    by_index: dict[str, list[RoutedChanges]] = {}
    for r in routed:
        by_index.setdefault(r.index, []).append(r)

    per_index = []
    for index, branches in by_index.items():
        attrs = _index_attrs(branches)
        words = _word_names("w", attrs)
        parts = []
        for r in branches:
            cols = [F.col(w) for w in _word_names("c", r.columns)]
            feeds: dict[str, Column] = {}
            for attr in attrs:
                hits = [flags.has(r.columns, cols, c) for c in r.columns if attr in r.column_map.get(c, ())]
                if hits:
                    feeds[attr] = reduce(lambda x, y: x | y, hits)
            masks = [m.alias(w) for m, w in zip(flags.pack(attrs, feeds), words)]
            parts.append(changed_column_flags(r, within).select("doc_id", *masks))
        docs = reduce(DataFrame.unionByName, parts)
        if len(parts) > 1:
            docs = docs.groupBy("doc_id").agg(*[F.bit_or(w).alias(w) for w in words])
        names = flags.unpack(attrs, [F.col(w) for w in words])
        any_set = reduce(lambda x, y: x | y, [F.col(w) != 0 for w in words])
        per_index.append(
            docs.where(any_set).select(F.lit(index).alias("index"), "doc_id", names.alias("attrs"))
        )
    return reduce(DataFrame.unionByName, per_index)


def unchanged_docs(routed: Sequence[RoutedChanges], changed: DataFrame) -> DataFrame:
    """Documents that were touched but did not change."""
    seen = [r.df.select("index", "doc_id") for r in routed]
    return reduce(DataFrame.unionByName, seen).distinct().join(
        changed.select("index", "doc_id"), ["index", "doc_id"], "left_anti"
    )
