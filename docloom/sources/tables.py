"""Base tables the document queries read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def parquet_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """`<folder>/<name>.parquet` per table."""
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition an input that has fewer splits than the session has cores.

    A file with one row group is read by one task, and all map-side work on it would stay there.  Inputs with enough
    splits, as all large ones have, are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def jdbc_tables(
    spark: SparkSession, url: str, tables: Mapping[str, str], properties: Mapping[str, str], **options
) -> dict[str, DataFrame]:
    """Tables of a database (name -> database table).

    Pass partitionColumn, lowerBound, upperBound and numPartitions for parallel reads.
    """
    frames = {}
    for name, dbtable in tables.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
        for key, value in {**properties, **options}.items():
            reader = reader.option(key, value)
        frames[name] = reader.load()
    return frames
