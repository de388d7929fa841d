"""Substring dedup by line or paragraph hashes.

Each text is cut into units (lines, or paragraphs parted by blank lines). Units are normalised (A-Z to a-z, runs of white space
to one blank) and digested; digests are grouped over all documents; of equal units the earliest by (doc_id, place) stays and
every other one goes. Offsets are characters of the original text. Every unit with a word counts, however short; `min_words` leaves shorter
ones out on request. Passages that do not fill whole units are beyond this method: see passage_dedup.

Counting is combined before it is shuffled, so a line that a third of all documents hold costs no task more than others; the
look-up of keepers is a join that adaptive execution splits.

Null or empty text: no units. Null doc_id: ranked last, each such document for itself; `cleaned` leaves them as they are, since it finds
documents by their id. A document that is given twice with the same doc_id counts once: its units have the same rank and stay or go
together. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm import scan
from fleetprep.llm.tables import only, query, table

UNIT = "doc_id long, rank long, unit long, nameless long, start long, stop long, n_words long, d1 long, d2 long"
#: units that contain no line feed, or no empty line
CUTS = {"line": re.compile(r"[^\n]+"), "paragraph": re.compile(r"[^\n]+(?:\n[^\n]+)*")}
LAST = 2**63 - 1
BLANKS = re.compile(rb"[\x20\x09-\x0D]+")


def units_of(text: str, cut: re.Pattern, min_words: int):
    """(place, start, stop, words, digest) of the units that can go."""
    for place, found in enumerate(cut.finditer(text)):
        words = BLANKS.split(found.group().encode("utf-8", "surrogatepass").lower().strip(b"\x20\t\n\x0b\x0c\r"))
        if len(words) >= min_words and words[0]:
            yield place, found.start(), found.end(), len(words), xxhash.xxh3_128_digest(b" ".join(words))


def units(docs: DataFrame, by: str, min_words: int) -> DataFrame:
    cut = CUTS[by]

    def run(batches):
        nameless = TaskContext.get().partitionId() << 40  # numbers documents without an id, so that their units differ in rank
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                rows = []
                for doc, text in zip(batch.column("doc_id").slice(lo, hi - lo).to_pylist(), column.to_pylist()):
                    rank = LAST if doc is None else doc
                    nameless += doc is None
                    rows += [
                        (doc, rank, place, nameless if doc is None else 0, a, b, n, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True))
                        for place, a, b, n, d in units_of(text, cut, min_words)
                    ]
                names = [c.split()[0] for c in UNIT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(9)], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, UNIT)


def judged(docs: DataFrame, by: str = "line", min_words: int = 1) -> DataFrame:
    """Every unit: doc_id, unit (place among the units), start, stop, n_words, kept, and kept_doc_id, kept_unit, copies."""
    rows = stage(units(only(docs, "doc_id", "text"), by, min_words))
    place = F.struct("rank", "nameless", "unit")
    keepers = rows.groupBy("d1", "d2").agg(F.min(place).alias("keep"), F.count("*").alias("copies")).where("copies > 1")
    both = rows.join(keepers, ["d1", "d2"], "left")
    alone = F.col("keep").isNull()
    kept_doc = F.when(alone, F.col("doc_id")).when(F.col("keep.rank") < LAST, F.col("keep.rank"))
    return both.select(
        "doc_id", "unit", "start", "stop", "n_words", (alone | (place == F.col("keep"))).alias("kept"), kept_doc.alias("kept_doc_id"),
        F.when(alone, F.col("unit")).otherwise(F.col("keep.unit")).alias("kept_unit"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
    )


def removals(docs: DataFrame, by: str = "line", min_words: int = 1) -> DataFrame:
    """The units that go."""
    return judged(docs, by, min_words).where(~F.col("kept")).drop("kept")


def cleaned(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """The documents without the removed units (nor the line feed after each), and `spans`: the original offsets of what went."""
    spans = removed.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    text = F.aggregate(
        "spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.struct(
            F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))).alias("out"),
            (x["stop"] + 1).alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text"))),
    )
    both = docs.drop("spans").join(spans, "doc_id", "left")
    return both.withColumn("text", F.when(F.col("spans").isNull(), F.col("text")).otherwise(text))


_SQL = """
WITH u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
o AS (SELECT doc_id, line, i, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS start FROM u),
p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS unit, start, start + length(line) AS stop,
  regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM o WHERE line <> ''),
k AS (SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, unit) AS r, count(*) OVER (PARTITION BY words) AS copies,
  first(doc_id) OVER (PARTITION BY words ORDER BY doc_id, unit) AS kept_doc_id, first(unit) OVER (PARTITION BY words ORDER BY doc_id, unit) AS kept_unit FROM p WHERE len(words) >= 1)
SELECT doc_id, unit, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, CAST(len(words) AS BIGINT) AS n_words, r = 1 AS kept, kept_doc_id, kept_unit, copies FROM k
"""


@query("op2_line_dedup", _SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


@query("op2_every_line_dedup", f"SELECT * EXCLUDE (kept) FROM ({_SQL}) WHERE NOT kept")
def op2_every(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2_line_dedup takes out, alone."""
    return removals(table(spark, sf_dir, "documents"))
