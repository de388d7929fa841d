"""Staging in the shared folder, and one-row results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a scratch folder only for a local session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the shared folder and go on from that table.

    Unlike a cache it survives the loss of executors, and later reads prune columns and push filters down.
    """
    path = os.path.join(shared_folder(df.sparkSession), "stage-" + uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, most: int = 1 << 20) -> None:
    """From now on rows go to Python workers in Arrow batches of about 1 MB instead of Spark's 64 MB, unless the session sets a size of its own.

    A batch stands in the executor's JVM, in the worker, and twice while it is copied; results do not depend on its size.
    """
    if spark.conf.get(BATCH_BYTES, "64m") in ("67108864b", "67108864", "64m"):
        spark.conf.set(BATCH_BYTES, str(most))


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for rows that are about to be passed over many times."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def one_row(df: DataFrame, aggregates: dict[str, Column]) -> dict:
    """Run the aggregates in one pass over the rows and return the single result row."""
    return df.agg(*[c.alias(k) for k, c in aggregates.items()]).first().asDict() if aggregates else {}
