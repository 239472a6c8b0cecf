"""What several operators share: word pattern, tables, names that can't clash, spreading of small inputs."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import new_dir

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(text: str | Column = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of `df` has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Whether Spark removes an execution's shuffle files at its end; else they stay until the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, computed once, written as compact Parquet under the shared folder and read back. Its shuffle files are freed."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove what `written` wrote, once all that is made of it has been written itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: int, rows: int = 256, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `rows` rows and, if they have several, about `size` bytes of the text column."""
    held = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        full = int(np.searchsorted(held, (held[at - 1] if at else 0) + size, side="right"))
        end = min(batch.num_rows, at + rows, max(full, at + 1))
        yield batch.slice(at, end - at)
        at = end


def let_go() -> None:
    """Give back to the system what earlier tasks of this worker have freed; workers are used again by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
