"""The tables the queries read, and how queries of this folder are registered."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: fixed values: what counts as a word
WORD = r"[^\x20\x09-\x0D]+"

RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, name + ".parquet"))


def query(label: str, sql: str | None = None):
    def register(run):
        RUN[label] = run
        if sql:
            SQL[label] = sql
        return run

    return register


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, whatever others there are."""
    return df.select(*[f"`{c}`" for c in columns])


def plus(schema: StructType, more: str) -> StructType:
    """A schema with more columns behind, given as DDL."""
    return StructType([*schema, *StructType.fromDDL(more)])
