"""Saved parameters applied to rows that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetprep.operators.prepare import Params, Rules, transform


def read_features(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def write_prepared(
    rows: DataFrame, params: Params, out: str, checkpoint: str, rules: Rules = Rules()
) -> StreamingQuery:
    """Transform the stream as a projection - no state, nothing relearned - and append it once each to Parquet."""
    prepared = transform(rows, params, rules)
    return (
        prepared.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
