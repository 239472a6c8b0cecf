"""The document table: partitioned Parquet with a published version.

Layout under one root folder:

* `base/doc_version=<n>/doc_write=<w>/doc_part=<k>`   full documents written by a rebuild or a compaction,
* `delta/doc_version=<n>/doc_write=<w>/doc_part=<k>`  documents put or deleted by one change batch,
* `versions/<n>.json`                                 what version n consists of and how far in the feed it is.

A job writes its files first and publishes them by creating the version file, filled, in one step (`once`), so a failed
job leaves the table as it was, and data and position change together.  A change batch writes its own documents only, whatever the
table's size; readers put the latest delta of a document in place of its base row, and a compaction of the
parts whose deltas have grown folds them into the base.

Every write has a folder of its own, so no writer touches what another has written.  Of writers that want the same
version number one creates the file.  The others go on from what it published if that can't have changed their result:
upkeep, a rebuild's swap, and a change batch that only upkeep came before.  A change batch that met another one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.coerce import part_of
from docloom.operators.restrict import anti, semi
from docloom.plans.once import put_once
from docloom.session import staged

# Names in stored files beside the document columns; sources refuse them as column names.
VERSION = "doc_version"
WRITE = "doc_write"
PART = "doc_part"
DELETED = "_deleted"

#: With at most so many parts, tasks that hold many documents each write their documents of every part, without a shuffle.
FEW_PARTS = 8


@dataclass
class Version:
    """One published state.  `base` and `delta` map writes, as `<version>-<write id>`, to the parts still read from them.

    `stream` names the source of batch ids: the same number from another stream is another batch.
    """

    version: int
    kind: str
    schema: str
    id_column: str
    parts: int
    base: dict[str, list[int]] = field(default_factory=dict)
    delta: dict[str, list[int]] = field(default_factory=dict)
    batch_id: int | None = None
    stream: str = ""
    seq: int | None = None
    event_id: int | None = None
    build_id: str | None = None
    ts: float | None = None
    n_replace: int = 0
    n_update: int = 0
    n_delete: int = 0
    replaying: bool = False  # rebuilt, and what came after `seq` is still to be applied again

    def has_batch(self, stream: str, batch_id: int | None) -> bool:
        return batch_id is not None and self.batch_id is not None and stream == self.stream and batch_id <= self.batch_id


#: Kinds of versions that leave the documents and the position as they are.
UPKEEP = ("compact", "merge")


class WriteConflict(RuntimeError):
    """Another writer published what this one has not seen."""


class TableNotReady(RuntimeError):
    """No version is published, or the published one has another schema."""


class DocTable:
    """A document table at `root`; every method reads the currently published version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # files ------------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _folder(self, kind: str, write: str) -> str:
        version, _, name = write.partition("-")
        return f"{self.root}/{kind}/{VERSION}={version}/{WRITE}={name}"

    def _parts_written(self, kind: str, write: str) -> list[int]:
        names = self._names(self._folder(kind, write))
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{PART}="))

    # versions -----------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = self._names(f"{self.root}/versions")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current(self, version: int | None = None) -> Version | None:
        """The latest version, or the given one.  A version file that was begun and never filled counts as absent."""
        known = self.versions()
        if version is not None:
            found = self._record(version) if version in known else None
            if found is None:
                raise TableNotReady(f"{self.root} has no version {version}")
            return found
        for n in reversed(known):
            if found := self._record(n):
                return found
        return None

    def _record(self, version: int) -> Version | None:
        fs, p = self._fs(f"{self.root}/versions/{version:012d}.json")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Version(**json.loads(text))
        except ValueError:
            return None

    def _create(self, v: Version) -> bool:
        """Create the version file, filled, in one step, unless it exists."""
        return put_once(self.spark, f"{self.root}/versions/{v.version:012d}.json", json.dumps(asdict(v)).encode())

    def _publish(self, made: Callable[[Version | None], Version]) -> Version:
        """Publish `made(current version)` under the next free number.

        `made` is asked again if another writer took the number; it raises WriteConflict if it can't go on from there.
        The number is taken before the current version is looked at, so whatever is published in between takes it.
        """
        while True:
            number = self._next()
            v = made(self.current())
            v.version = number
            if self._create(v):
                return v

    def _need(self) -> Version:
        v = self.current()
        if v is None:
            raise TableNotReady(f"{self.root} has no published version")
        return v

    def is_ready(self, schema: T.StructType, id_column: str | None = None, parts: int | None = None) -> bool:
        """Whether a version is published with the declared columns, id column and number of parts, and all its files."""
        v = self.current()
        return (
            v is not None
            and _columns(_struct(v.schema)) == _columns(schema)
            and id_column in (None, v.id_column)
            and parts in (None, v.parts)
            and all(
                set(in_use) <= set(self._parts_written(kind, write))
                for kind in ("base", "delta")
                for write, in_use in getattr(v, kind).items()
            )
        )

    # writing ------------------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, id_column: str, parts: int, kind: str, version: int) -> dict[str, list[int]]:
        """Write rows by part into a new folder: its name and its parts."""
        return self._write_placed(_by_part(rows, id_column, parts), kind, version)

    def _write_many(self, rows: DataFrame, id_column: str, parts: int, kind: str, version: int) -> dict[str, list[int]]:
        """The same for rows that are enough for each task to write a file of every part."""
        return self._write_placed(_by_part(rows, id_column, parts, many=True), kind, version)

    def _write_laid_out(self, rows: DataFrame, id_column: str, parts: int, kind: str, version: int) -> dict[str, list[int]]:
        """The same for rows that were `staged_by_part` for this number of parts, without a shuffle."""
        return self._write_placed(_placed(rows, id_column, parts).sortWithinPartitions(PART, id_column), kind, version)

    def _write_placed(self, rows: DataFrame, kind: str, version: int) -> dict[str, list[int]]:
        write = f"{version}-{uuid.uuid4().hex}"
        files = rows.write.mode("errorifexists").option("compression", "zstd").partitionBy(PART)
        files.parquet(self._folder(kind, write))
        written = self._parts_written(kind, write)
        return {write: written} if written else {}

    def _next(self) -> int:
        known = self.versions()
        return known[-1] + 1 if known else 1

    def build(
        self, documents: DataFrame, id_column: str, parts: int, *,
        seq=None, event_id=None, build_id=None, ts=None, replaying=False, laid_out=False,
    ) -> Version:
        """Write the whole table as a new version without publishing it.

        `laid_out` says that the documents were `staged_by_part` for `parts`.
        A version that is `replaying` keeps its position until a batch is applied as its replay, whatever else is applied.
        """
        n = self._next()
        if laid_out:
            written = self._write_laid_out(documents, id_column, parts, "base", n)
        else:
            written = self._write_many(documents, id_column, parts, "base", n)
        return Version(
            n, "rebuild", documents.schema.json(), id_column, parts, base=written,
            seq=seq, event_id=event_id, build_id=build_id, ts=ts, replaying=replaying,
        )

    def publish(self, built: Version) -> Version:
        """Swap a built version in, whatever was published since it was begun; its position says from where changes are
        to be applied again.  Readers that started before keep reading the files of theirs."""
        return self._publish(lambda _: Version(**asdict(built)))

    def rebuild(self, documents: DataFrame, id_column: str, parts: int, **position) -> Version:
        """Replace the whole table; the old version stays until all parts are written."""
        return self.publish(self.build(documents, id_column, parts, **position))

    def rebuild_part(self, documents: DataFrame, part: int) -> Version:
        """Replace one partition by `documents`, which must all belong to it."""
        old = self._need()
        written = self._write(documents, old.id_column, old.parts, "base", self._next())
        found = sorted(k for ks in written.values() for k in ks)
        if found not in ([], [part]):
            raise ValueError(f"documents of parts {found} given for part {part}")
        return self._publish(lambda now: self._folded(self._only_upkeep(old, now), old, [part], written, "rebuild", whole=True))

    def _only_upkeep(self, old: Version, now: Version | None) -> Version:
        """`now`, if nothing but upkeep was published after `old`."""
        for n in self.versions():
            if n > old.version and (v := self._record(n)) and v.kind not in UPKEEP:
                raise WriteConflict(f"version {n} of {self.root} ({v.kind}) was published by another writer")
        if now is None:
            raise TableNotReady(f"{self.root} has no published version")
        return now

    def _folded(
        self, now: Version, old: Version, replaced: Iterable[int], written: dict[str, list[int]], kind: str, whole: bool = False
    ) -> Version:
        """`now` with the parts' files that `old` had (or all of them, if `whole`) replaced by the written ones."""
        gone = set(replaced)
        v = Version(**{**asdict(now), "kind": kind, "n_replace": 0, "n_update": 0, "n_delete": 0})
        for files, before in ((v.base, old.base), (v.delta, old.delta)):
            for key in list(files):
                if whole or key in before:
                    files[key] = [k for k in files[key] if k not in gone]
                if not files[key]:
                    del files[key]
        v.base.update(written)
        return v

    def apply(
        self,
        decided: DataFrame,
        *,
        batch_id: int | None = None,
        stream: str = "",
        seq: int | None = None,
        event_id: int | None = None,
        ts: float | None = None,
        upsert_missing: bool = True,
        advance: bool = True,
        replay: bool = False,
        laid_out: int | None = None,
        many: bool = False,
    ) -> Version:
        """Apply decided documents (`doc_id, action, attrs, doc`) as one batch.

        A batch of the same stream that is already part of the table is skipped.  With `upsert_missing`, an in-place update writes
        the whole current document, which also heals one the table lacks; without it, an update changes the
        named attributes of documents the table has and is otherwise lost.  `advance=False` applies the batch but
        keeps the recorded position, as during a rebuild; so does a table whose replay is open, unless this is the
        `replay`.  `laid_out` is the number of parts that the documents were `staged_by_part` for.  `many` says that there are
        enough documents for each task to write a file of every part.
        """
        old = self._need()
        if old.has_batch(stream, batch_id):
            return old
        schema = _struct(old.schema)
        content = [f.name for f in schema.fields if f.name != old.id_column]

        rows = decided.select(
            F.col("doc_id").alias(old.id_column),
            *[F.col(f"doc.{c}") for c in content],
            (F.col("action") == "delete").alias(DELETED),
            F.col("action").alias("_action"),
            *([] if upsert_missing else [F.col("attrs").alias("_attrs")]),
        )
        if not upsert_missing:
            rows = self._patched(rows, old, content)
        seen = Observation()
        counted = rows.observe(
            seen, *[F.count_if(F.col("_action") == a).alias(a) for a in ("replace", "update", "delete")]
        )
        counted, n = counted.drop("_action"), self._next()
        if upsert_missing and laid_out == old.parts:
            written = self._write_laid_out(counted, old.id_column, old.parts, "delta", n)
        else:
            write = self._write_many if many else self._write
            written = write(counted, old.id_column, old.parts, "delta", n)
        counts = seen.get

        def made(now: Version | None) -> Version:
            now = self._only_upkeep(old, now)
            moves = advance and (replay or not now.replaying)
            v = Version(**{**asdict(now), "kind": "apply" if moves else "apply-frozen"})
            v.replaying = now.replaying and not replay
            v.delta.update(written)
            if batch_id is not None:
                v.batch_id, v.stream = batch_id, stream
            if moves:
                v.seq = now.seq if seq is None else seq
                v.event_id = now.event_id if event_id is None else event_id
            v.ts = ts
            v.n_replace, v.n_update, v.n_delete = counts["replace"], counts["update"], counts["delete"]
            return v

        return self._publish(made)

    def _patched(self, rows: DataFrame, old: Version, content: list[str]) -> DataFrame:
        """Updates as full rows: named attributes from the source, the others from the table; the rest as it is."""
        updates = rows.where(F.col("_action") == "update")
        have = self.read(ids=updates.select(F.col(old.id_column).alias("doc_id")))
        mine = have.select(F.col(old.id_column).alias("_id"), *[F.col(c).alias(f"_old_{c}") for c in content])
        patched = updates.join(mine, F.col(old.id_column) == F.col("_id")).select(
            old.id_column,
            *[
                F.when(F.array_contains("_attrs", c), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c)
                for c in content
            ],
            DELETED,
            "_action",
        )
        return rows.where(F.col("_action") != "update").drop("_attrs").unionByName(patched)

    def set_position(
        self,
        seq: int | None,
        event_id: int | None = None,
        batch_id: int | None = None,
        ts: float | None = None,
        stream: str = "",
        advance: bool = True,
        replay: bool = False,
    ) -> Version:
        """Publish the same data with another resume position; without `advance`, or while a replay is open that this
        isn't, with another batch only."""
        old = self._need()

        def made(now: Version | None) -> Version:
            now = self._only_upkeep(old, now)
            v = Version(**{**asdict(now), "kind": "position", "ts": ts})
            v.replaying = now.replaying and not replay
            if advance and not v.replaying:
                v.seq, v.event_id = seq, event_id
            v.n_replace = v.n_update = v.n_delete = 0
            if batch_id is not None:
                v.batch_id, v.stream = batch_id, stream
            return v

        return self._publish(made)

    def trim_history(self, keep: int) -> list[int]:
        """Forget all but the last `keep` version records, and remove the files that only the forgotten ones read."""
        known = self.versions()
        old, kept = known[: -max(1, keep)], known[-max(1, keep) :]

        def writes(numbers: Iterable[int]) -> set[tuple[str, str]]:
            records = [r for n in numbers if (r := self._record(n))]
            return {(kind, w) for r in records for kind in ("base", "delta") for w in getattr(r, kind)}

        for kind, write in writes(old) - writes(kept):
            self._delete(self._folder(kind, write))
        for n in old:
            self._delete(f"{self.root}/versions/{n:012d}.json")
        return old

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    # reading ------------------------------------------------------------------------------------------------

    def _files(self, kind: str, v: Version, schema: T.StructType, parts: Iterable[int] | None) -> DataFrame | None:
        wanted = None if parts is None else set(parts)
        paths = []
        for write, in_use in sorted(getattr(v, kind).items()):
            folder = self._folder(kind, write)
            if wanted is None and in_use == self._parts_written(kind, write):
                paths.append(folder)
            else:
                paths += [f"{folder}/{PART}={k}" for k in in_use if wanted is None or k in wanted]
        if not paths:
            return None
        stored = [T.StructField(VERSION, T.LongType()), T.StructField(WRITE, T.StringType()), T.StructField(PART, T.IntegerType())]
        full = T.StructType(schema.fields + stored)
        return self.spark.read.schema(full).option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def read(
        self, ids: DataFrame | None = None, parts: Iterable[int] | None = None, version: int | None = None
    ) -> DataFrame:
        """Documents of the published version; `ids` (column `doc_id`) and `parts` cut it down before merging."""
        v = self.current(version)
        if v is None:
            raise TableNotReady(f"{self.root} has no published version")
        schema = _struct(v.schema)
        key = v.id_column
        columns = [f.name for f in schema.fields]
        parts = None if parts is None else list(parts)
        base = self._files("base", v, schema, parts)
        delta_schema = T.StructType(schema.fields + [T.StructField(DELETED, T.BooleanType())])
        delta = self._files("delta", v, delta_schema, parts)
        if ids is not None:
            base, delta = (df if df is None else semi(df, key, ids) for df in (base, delta))
        if base is None:
            base = self.spark.createDataFrame([], schema)
        if delta is None:
            return base.select(*columns)
        latest = self._latest(delta, columns, key, list(v.delta))
        kept = anti(base.select(*columns), key, delta.select(key))
        return kept.select(*columns).unionByName(latest.where(~F.col(DELETED)).select(*columns))

    # upkeep -------------------------------------------------------------------------------------------------

    def file_sizes(self) -> DataFrame:
        """Files of the published version: `kind, part, path, bytes`, from the file listing alone."""
        v = self._need()
        frames = []
        for kind in ("base", "delta"):
            paths = [f"{self._folder(kind, w)}/{PART}={k}" for w, ks in getattr(v, kind).items() for k in ks]
            if paths:
                listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
                part = F.regexp_extract("path", rf"/{PART}=(\d+)/", 1).cast("int")
                frames.append(
                    listed.select(
                        F.lit(kind).alias("kind"), part.alias("part"), "path", F.col("length").alias("bytes")
                    )
                )
        if not frames:
            return self.spark.createDataFrame([], "kind string, part int, path string, bytes bigint")
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def _latest(self, delta: DataFrame, columns: list[str], key: str, writes: list[str]) -> DataFrame:
        """The last delta row of each document.

        A write has one row for each of its documents, so those of the newest one are taken as they are, and only rows of
        the older ones whose documents it lacks are looked at further.
        """
        versions = sorted(int(w.partition("-")[0]) for w in writes)
        if len(set(versions)) < len(versions):
            return self._max_by_version(delta, columns, key)
        newest = delta.where(F.col(VERSION) == versions[-1])
        last = newest.select(*columns, DELETED)
        if len(versions) == 1:
            return last
        older = delta.where(F.col(VERSION) < versions[-1]).join(newest.select(key), key, "left_anti")
        rest = self._max_by_version(older, columns, key) if len(versions) > 2 else older.select(*columns, DELETED)
        return last.unionByName(rest)

    def _max_by_version(self, delta: DataFrame, columns: list[str], key: str) -> DataFrame:
        row = F.max_by(F.struct(*columns, DELETED), VERSION).alias("_row")
        return delta.groupBy(F.col(key).alias("_id")).agg(row).select("_row.*")

    def merge_deltas(self) -> Version:
        """Fold the deltas of many small batches into one; the base files stay."""
        old = self._need()
        if len(old.delta) < 2:
            return old
        schema = _struct(old.schema)
        columns = [f.name for f in schema.fields]
        delta = self._files("delta", old, T.StructType(schema.fields + [T.StructField(DELETED, T.BooleanType())]), None)
        # it stands where the last of the merged ones stood, below all that are published meanwhile
        last = max(int(w.partition("-")[0]) for w in old.delta)
        written = self._write(self._latest(delta, columns, old.id_column, list(old.delta)), old.id_column, old.parts, "delta", last)

        def made(now: Version | None) -> Version:
            self._same_files(old, now)
            rest = {w: ks for w, ks in now.delta.items() if w not in old.delta}
            v = Version(**{**asdict(now), "kind": "merge", "delta": {**written, **rest}})
            v.n_replace = v.n_update = v.n_delete = 0
            return v

        return self._publish(made)

    def compact(self, parts: Iterable[int]) -> Version:
        """Fold the deltas of `parts` into new base files; other parts keep theirs, and so do later deltas."""
        old = self._need()
        parts = sorted(set(parts))
        if not parts:
            return old
        written = self._write(self.read(parts=parts, version=old.version), old.id_column, old.parts, "base", self._next())

        def made(now: Version | None) -> Version:
            self._same_files(old, now)
            return self._folded(now, old, parts, written, "compact")

        return self._publish(made)

    def _same_files(self, old: Version, now: Version | None) -> None:
        """Refuse to go on if the files that were folded are not all there any more."""
        if now is None or any(getattr(now, k).get(w) != ks for k in ("base", "delta") for w, ks in getattr(old, k).items()):
            raise WriteConflict(f"the files of {self.root} were replaced by another writer")


def _placed(rows: DataFrame, id_column: str, parts: int) -> DataFrame:
    return rows.withColumn(PART, part_of(F.col(id_column), parts))


def _by_part(rows: DataFrame, id_column: str, parts: int, many: bool = False) -> DataFrame:
    """Rows shuffled by part and sorted by id, so that lookups by id skip row groups.

    `rebalance` lets Spark split parts that are too large for one task and merge small ones, going by the sizes it
    measured in the shuffle.  With `many` rows and few parts the rows stay in the tasks they are in, and each task writes a
    file of every part.
    """
    placed = _placed(rows, id_column, parts)
    if not (many and parts <= FEW_PARTS):
        placed = placed.hint("rebalance", PART)
    return placed.sortWithinPartitions(PART, id_column)


def staged_by_part(rows: DataFrame, id_column: str, parts: int, name: str, many: bool = False) -> DataFrame:
    """Rows written by part once, for several tables that each take them from there without a shuffle."""
    return staged(_by_part(rows, id_column, parts, many).drop(PART), name)


def _struct(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
