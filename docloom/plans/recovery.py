"""What to do at start: resume, or rebuild some or all indexes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.plans.commits import replicas_agree
from docloom.plans.rebuild import RebuildLog, rebuild_group
from docloom.plans.sync import SyncJob
from docloom.plans.target import Version


def target_readiness(spark: SparkSession, job: SyncJob, frames: Mapping[str, DataFrame]) -> DataFrame:
    """`index, replica, ready`: a target is ready when it is published as declared, with all its files."""
    rows = []
    for index, source in job.sources.items():
        schema = source.schema(spark, frames)
        key = source.id_column(spark, frames)
        rows += [(index, i, t.is_ready(schema, key, source.parts)) for i, t in enumerate(job.targets[index])]
    return spark.createDataFrame(rows, "index string, replica int, ready boolean")


def recovery_plan(
    spark: SparkSession,
    job: SyncJob,
    frames: Mapping[str, DataFrame],
    *,
    force: bool = False,
    reset: bool = False,
) -> DataFrame:
    """`index, action, reason`.

    A forced start or a reset flag rebuilds everything.  Otherwise an index is rebuilt if a target of it is not ready, if a
    rebuild before it died in its replay, or if its replicas are at different positions; other indexes resume from theirs, which may differ from one to another.
    """
    ready = target_readiness(spark, job, frames).groupBy("index").agg(F.every("ready").alias("ready"))
    if force or reset:
        why = F.lit("forced" if force else "reset")
        return ready.select("index", F.lit("rebuild").alias("action"), why.alias("reason"))
    agree = [
        replicas_agree(spark, {str(k): t for k, t in enumerate(tables)}).select(F.lit(index).alias("index"), "agree")
        for index, tables in job.targets.items()
    ]
    # one row for each index
    open_ = [(i, any(v.replaying for t in ts if (v := t.current()))) for i, ts in job.targets.items()]
    state = ready.join(reduce(DataFrame.unionByName, agree), "index")
    state = state.join(spark.createDataFrame(open_, "index string, open boolean"), "index")
    fine = F.col("ready") & F.col("agree") & ~F.col("open")
    reason = F.when(F.col("open"), "replay is open").when(~F.col("agree"), "replicas disagree").when(F.col("ready"), "ready").otherwise("not ready")
    return state.select("index", F.when(fine, "resume").otherwise("rebuild").alias("action"), reason.alias("reason"))


def recover(
    spark: SparkSession, job: SyncJob, frames: Mapping[str, DataFrame], log: RebuildLog, plan: DataFrame, **options
) -> dict[str, list[Version]]:
    """Rebuild what the plan says; the indexes that resume keep their tables and positions."""
    # one row for each index
    indexes = sorted(r["index"] for r in plan.where("action = 'rebuild'").select("index").collect())
    return rebuild_group(spark, job, frames, log, indexes=indexes, **options) if indexes else {}
