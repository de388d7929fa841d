"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # wide tables make stages longer than the JVM compiles; such stages run faster operator by operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # no call-site lookup for every column expression that Python builds
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str, app: str, memory: str = "12g", **more: str) -> SparkSession:
    """A one-machine session for tests and timings; on a cluster pass SETTINGS to spark-submit instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS, "spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": memory,
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **more,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
