"""Substring dedup by word windows, whatever lines they lie in.

Words (runs without white space, A-Z to a-z) of a document form windows of `width` words in a row, across line ends. Of equal windows
over all documents the earliest by (doc_id, place) is the first copy. A word goes when it lies in a later copy of a window and in no
first copy, so every passage that goes still stands in full somewhere. Offsets are characters of the original text; words in a row
that go make one row.

Shuffling a digest of every window would take many times the input. Each window has a sample instead: of the windows of half the width
inside it, the leftmost of those with the least hash (winnowing). Windows in a row with one sample form a block, some 13 windows for 50
words, and one row a block is shuffled. Equal windows have equal samples at the same distance, hence:

* a block whose sample stands nowhere else holds no window that repeats;
* of equal blocks the earliest one stays, and all windows of the others are later copies;
* if all blocks around a sample are equal, the windows of the earliest are first copies;
* only where blocks around a sample differ, as at the ends of a passage, the windows of one block of each kind are compared one by one.

No window that repeats is lost by this. Windows count as equal if two hashes of 64 bits are, that of the sample and one of all words.

Null or empty text, and fewer than `width` words: no rows. Null doc_id: ranked last. Different texts of one doc_id, or of none, are
ranked by a hash of the text; equal texts of one doc_id count once. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm import scan
from fleetprep.llm.tables import only, query, table

LAST = 2**63 - 1
#: `run` is place << 6 | further windows, in the order of the places
BITS = 6
BLOCK = "rank long, uid long, run long, sample long, block long"
WINDOW = "rank long, uid long, run long, sample long, window long, copied boolean"
SPAN = "doc_id long, start long, stop long, n_words long"
_OTHER = np.uint64(0xA0761D6478BD642F)


def leftmost_least(x: np.ndarray, width: int) -> np.ndarray:
    """Where the least of x[i : i + width] stands first, as far as all of them exist."""
    at, have = np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        right = x[step:] < x[: len(x) - step]
        x, at = np.where(right, x[step:], x[: len(x) - step]), np.where(right, at[step:], at[: len(at) - step])
        have += step
    return at


def blocks(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Place and digest of each window; for each block the index of its first window, the further windows, its sample and digest."""
    half = width // 2
    digests, at = scan.windows(h, first, width)
    if not len(at):
        return at, digests, at, at, digests, digests
    some, where = scan.windows(scan.mix(h ^ _OTHER), first, half)
    hashes = np.zeros(len(h), np.uint64)
    hashes[where] = some
    least = leftmost_least(hashes, width - half + 1)[at]
    begin = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    more = np.diff(begin, append=len(at)) - 1
    # the first and the last window cover the block
    shape = (least[begin] - at[begin] << BITS | more).astype(np.uint64)
    block = scan.mix(digests[begin] ^ scan.mix(digests[begin + more] + scan.mix(shape ^ _OTHER)))
    return at, digests, begin, more, hashes[least[begin]], block


def inside(place: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the runs of `size` words that start at the places."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + size, -1)
    return np.cumsum(edge)[:n] > 0


def batch_of(columns: list[np.ndarray], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64), pa.int64()) for c in columns], names=[c.split()[0] for c in schema.split(", ")])


def in_blocks(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                t = scan.read(column, lower=True)
                at, _, begin, more, sample, block = blocks(t.word_hashes(), t.first, width)
                at = at[begin]
                doc = t.owner()[at]
                rank, uid = (batch.column(c).slice(lo, hi - lo).to_numpy()[doc] for c in ("rank", "uid"))
                yield batch_of([rank, uid, at - t.first[doc] << BITS | more, sample.view(np.int64), block.view(np.int64)], BLOCK)

    return docs.select("rank", "uid", "text").mapInArrow(run, BLOCK)


def flat(column: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in a column of lists of runs, as words of the slice, and their further windows."""
    sizes = pc.list_value_length(column).to_numpy()
    runs = column.flatten().to_numpy()
    return np.repeat(first[:-1], sizes) + (runs >> BITS), runs & (1 << BITS) - 1


def windows(found: DataFrame, width: int) -> DataFrame:
    """The windows of the blocks in `runs`, and whether their block has copies (those in `copied`)."""

    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                t = scan.read(column, lower=True)
                part = batch.slice(lo, hi - lo)
                at, digests, begin, more, sample, _ = blocks(t.word_hashes(), t.first, width)
                wanted, copied = (np.isin(at[begin], flat(part.column(c), t.first)[0]) for c in ("runs", "copied"))
                of = np.repeat(np.arange(len(begin)), more + 1)
                take = wanted[of]
                at, digests, of = at[take], digests[take], of[take]
                doc = t.owner()[at]
                rank, uid = (part.column(c).to_numpy()[doc] for c in ("rank", "uid"))
                rest = batch_of([rank, uid, at - t.first[doc] << BITS, sample[of].view(np.int64), digests.view(np.int64)], WINDOW.rsplit(", ", 1)[0])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(copied[of])], names=[c.split()[0] for c in WINDOW.split(", ")])

    return found.mapInArrow(run, WINDOW)


def spans(found: DataFrame, width: int) -> DataFrame:
    """The runs of words that lie in a later copy (`later`) and in no first copy (`firsts`)."""

    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                t = scan.read(column)
                n = len(t.start)
                later, firsts = (inside(at, more + width, n) for at, more in (flat(batch.column(c).slice(lo, hi - lo), t.first) for c in ("later", "firsts")))
                goes = later & ~firsts
                chars = np.concatenate(([0], np.cumsum((t.buf & 0xC0) != 0x80)))
                owner = t.owner()
                new = np.concatenate(([True], owner[1:] != owner[:-1])) if n else np.zeros(0, bool)
                starts = np.flatnonzero(goes & (new | ~np.concatenate(([False], goes[:-1]))))
                ends = np.flatnonzero(goes & (np.concatenate((new[1:], [True])) | ~np.concatenate((goes[1:], [False])))) if n else starts
                doc = owner[starts]
                base = chars[t.off[doc]]
                ids = batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc))
                rest = batch_of([chars[t.start[starts]] - base, chars[t.end[ends]] - base, ends - starts + 1], SPAN.split(", ", 1)[1])
                yield pa.RecordBatch.from_arrays([ids, *rest.columns], names=[c.split()[0] for c in SPAN.split(", ")])

    return found.mapInArrow(run, SPAN)


def marked(rows: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Runs of windows that repeat: rank, uid, run, and whether they are later copies."""
    place = F.struct("rank", "uid", "run")
    rows = stage(rows)
    samples = rows.groupBy("sample").agg(F.count("*").alias("n"), (F.min("block") != F.max("block")).alias("mixed")).where("n > 1").drop("n")
    twice = stage(rows.join(samples, "sample"))
    # by their places, since a document that is given twice has equal rows and no copies
    kinds = twice.groupBy("sample", "block").agg(F.min(place).alias("keep"), F.max(place).alias("last"))
    judged = twice.join(kinds, ["sample", "block"]).select("rank", "uid", "run", "mixed", (place != F.col("keep")).alias("later"), (F.col("keep") != F.col("last")).alias("copied"))
    judged = stage(judged.where("mixed OR copied"))
    settled = judged.where("later OR NOT mixed").select("rank", "uid", "run", "later")
    open_ = judged.where("mixed AND NOT later").groupBy("rank", "uid").agg(F.collect_set("run").alias("runs"), F.collect_set(F.when(F.col("copied"), F.col("run"))).alias("copied"))
    near = windows(docs.join(open_, ["rank", "uid"]), width)  # twice in one plan, with one shuffle of the texts; to stage it would shuffle them again
    firsts = near.groupBy("sample", "window").agg(F.min(place).alias("keep"), F.max(place).alias("last"), F.max("copied").alias("any_copied")).where("any_copied OR keep != last")
    return settled.union(near.join(firsts, ["sample", "window"]).select("rank", "uid", "run", (place != F.col("keep")).alias("later")))


def removals(docs: DataFrame, width: int = 50) -> DataFrame:
    """Every run of words that goes: doc_id, start, stop, n_words."""
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    docs = docs.withColumn("rank", F.coalesce("doc_id", F.lit(LAST))).withColumn("uid", F.xxhash64("rank", "text"))
    dealt = docs.repartition("rank", "uid")  # one shuffle, that the joins with texts share
    marks = marked(in_blocks(docs, width), dealt, width).groupBy("rank", "uid").agg(
        F.collect_set(F.when(F.col("later"), F.col("run"))).alias("later"), F.collect_set(F.when(~F.col("later"), F.col("run"))).alias("firsts"),
    ).where(F.size("later") > 0)
    return spans(dealt.join(marks, ["rank", "uid"]), width)


_SQL = """
WITH t AS (SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words,
  regexp_extract_all(text, '[\\x20\\x09-\\x0D]+') AS gaps, length(regexp_extract(text, '^[\\x20\\x09-\\x0D]+')) AS lead FROM documents),
d AS (SELECT * FROM t WHERE len(words) >= 50),
x AS (SELECT doc_id, i, array_to_string(words[i : i + 49], ' ') AS passage FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d)),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) AS r, count(*) OVER (PARTITION BY passage) AS copies FROM x),
g AS (SELECT DISTINCT doc_id, i + o AS i FROM k, (SELECT unnest(range(50)) AS o) WHERE r > 1
  EXCEPT SELECT doc_id, i + o FROM k, (SELECT unnest(range(50)) AS o) WHERE r = 1 AND copies > 1),
l AS (SELECT doc_id, lead, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word, unnest(list_concat(gaps[if(lead > 0, 2, 1) : ], [''])[1 : len(words)]) AS gap FROM d),
p AS (SELECT doc_id, i, length(word) AS n, lead + sum(length(word) + length(coalesce(gap, ''))) OVER (PARTITION BY doc_id ORDER BY i) - length(word) - length(coalesce(gap, '')) AS start FROM l),
s AS (SELECT doc_id, i, start, start + n AS stop, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g JOIN p USING (doc_id, i))
SELECT doc_id, CAST(min(start) AS BIGINT) AS start, CAST(max(stop) AS BIGINT) AS stop, count(*) AS n_words FROM s GROUP BY doc_id, run
"""


@query("op2_passage_dedup", _SQL)
def op2_passage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents"))
