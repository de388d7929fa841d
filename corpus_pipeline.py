"""The corpus pipeline: each stage works on all that the one before has kept, and its decisions take effect.

Rejected documents go, one document of each group of near duplicates stays (its smallest doc_id), documents that hold a benchmark item
go, the rest is repeated or left out to meet the target weights, and what remains is encoded to files and read back.

Null doc_id: such documents are judged and mixed like others but are in no group of duplicates that could drop them, and are never dropped as
contaminated. Several documents of one doc_id share their fate. Empty documents: no rows at every stage.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import shared_folder
from fleetprep.llm import decontamination, mixing, ngram_join, quality_classifier, token_files
from fleetprep.llm.tables import table


def columns_of(docs: DataFrame) -> list:
    """All columns, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def unused(docs: DataFrame, stem: str) -> str:
    """A column name that docs do not have."""
    while stem.lower() in {c.lower() for c in docs.columns}:
        stem += "_"
    return stem


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates."""
    copies = ngram_join.similar(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*columns_of(docs))


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    hits = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*columns_of(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    key, copies, copy = (unused(docs, c) for c in ("mix_id", "mix_copies", "mix_copy"))
    taken = mixing.mix(docs).groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").cast("int").alias(copies))
    both = docs.join(taken.where(F.col(copies) > 0), docs["doc_id"].eqNullSafe(F.col(key)))
    return both.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*columns_of(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids stand in the files, their number and checksum."""
    return token_files.encoded(docs, token_files.tokenizer_path())


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", not_in_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", tokens),
]

#: a trained classifier, alignments and a tokenizer are beyond SQL; tests/llm compares with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = os.path.join(shared_folder(spark), "pipeline-" + uuid.uuid4().hex)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
