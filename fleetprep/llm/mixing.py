"""Mix sources to target weights by systematic sampling, in DataFrame expressions only.

Every document of a source is expected `target / source_size` times. These expectations are summed up in the order (size,
doc_id) within the source, one random offset is added, and a document is taken once for each whole number that the sum passes
at it. Ordering by size makes the taken words follow the target closely. As the expectation is the same for all documents of a
source, the prefix sum is rate x rank; the rank is put together from three counts (by size, by block of 1024 ids, within the
block), so no task orders a whole source and equal sizes do not pile up.

Null or empty text: size 0, taken 0. Null source: a source of its own, last in order. Null doc_id: ranked as -1. Repeated rows:
each is a document. Source without words: target 0. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm.tables import WORD, only, query, table

#: fixed values: weights by rank of the source
WEIGHTS = (5, 2, 1)
SEED = "mix-1"
BLOCK_BITS = 10


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: the words of each whole text."""
    words = F.regexp_count(F.col("text").cast("string"), F.lit(WORD)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.coalesce(words, F.lit(0)).alias("size"))


def targets(rows: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target, one row per source.

    Sources in order of cap / weight: a source stays at its cap if its weight's part of what the earlier ones leave is no less.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.select("source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(most)).alias("cap"), F.row_number().over(by_name).alias("rank"))
    everything = Window.partitionBy()
    ahead = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    left = F.sum("source_size").over(everything) * F.lit(share) - (F.sum("cap").over(ahead) - F.col("cap"))
    weight_left = F.sum("w").over(everything) - (F.sum("w").over(ahead) - F.col("w"))
    s = s.withColumn("capped", F.col("cap") <= F.col("w") * left / weight_left)
    free = F.sum("source_size").over(everything) * F.lit(share) - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    free_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(everything)
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * free / free_weight).alias("target"))


def ranked(rows: DataFrame) -> DataFrame:
    """rows with `rank`: the place from 0 by (size, doc_id) within the source."""
    rows = rows.withColumn("place", F.coalesce(F.col("doc_id"), F.lit(-1))).withColumn("block", F.shiftright(F.col("place"), BLOCK_BITS))
    blocks = rows.groupBy("source", "size", "block").agg(F.count("*").alias("n"))
    steps = blocks.groupBy("source", "size").agg(F.sum("n").alias("n"))
    by_size, by_block = Window.partitionBy("source").orderBy("size"), Window.partitionBy("source", "size").orderBy("block")
    steps = steps.select(F.col("source").alias("s1"), F.col("size").alias("z1"), (F.sum("n").over(by_size) - F.col("n")).alias("smaller"))
    blocks = blocks.withColumn("earlier", F.sum("n").over(by_block) - F.col("n"))
    blocks = blocks.join(steps, F.col("source").eqNullSafe(F.col("s1")) & (F.col("size") == F.col("z1")))
    blocks = blocks.select(F.col("source").alias("s2"), F.col("size").alias("z2"), F.col("block").alias("b2"), (F.col("smaller") + F.col("earlier")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "size", "block").orderBy("place")) - 1
    rows = rows.withColumn("inside", inside)
    rows = rows.join(blocks, rows["source"].eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")) & (F.col("block") == F.col("b2")))
    return rows.select("doc_id", "source", "size", (F.col("before") + F.col("inside")).alias("rank"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every document."""
    rows = stage(sizes(only(docs, "doc_id", "source", "text")))
    goals = stage(targets(rows, share, most, weights)).withColumnRenamed("source", "s")
    both = ranked(rows).join(goals, F.col("source").eqNullSafe(F.col("s")), "left")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast("double") / 2**32
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(offset + rate * (F.col("rank") + 1)) - F.floor(offset + rate * F.col("rank"))
    both = both.withColumn("copies", copies.cast("long"))
    return both.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS w, source_size * CAST(2 AS DOUBLE) AS cap FROM s),
a AS (SELECT *, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS goal, sum(cap) OVER (ORDER BY cap / w, rank) - cap AS caps, sum(w) OVER () - (sum(w) OVER (ORDER BY cap / w, rank) - w) AS ws FROM w),
c AS (SELECT *, cap <= w * (goal - caps) / ws AS capped FROM a),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE w * (goal - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1 AS rank FROM d),
x AS (SELECT doc_id, size, source_size, target, rank, CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(r.source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u,
  CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * CAST(floor(u + rate * (rank + 1)) - floor(u + rate * rank) AS BIGINT) AS taken FROM x
"""


@query("op7_mixing", _SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
