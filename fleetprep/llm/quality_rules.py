"""Quality rules, judged per document and per host.

Each document is counted on its whole text; documents that break a base rule go. Rule failures are added up by host (here the
document's source), the hosts' failure rates are shrunk with a beta prior that is fitted to all hosts by the method of moments,
and the verdict on a host is joined back to its documents: a host whose shrunk rate passes `limit` loses all of them.

Null text: no words, so base_failed. Null host: a host of its own. Repeated rows: each counts and each is returned. Empty
table: no rows. Other columns are ignored. With fewer than two hosts, or with equal rates, there is nothing to learn a prior from
and the plain rate decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm import scan
from fleetprep.llm.tables import WORD, only, query, table

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = text.split(b"\n")
    if len(lines) == len(set(lines)):
        return 0
    seen, n = set(), 0
    for line in lines:
        if line in seen:
            n += bool(line.strip(b"\x20\t\n\x0b\x0c\r"))
        seen.add(line)
    return n


def repeated_words(x: scan.Texts, hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """For each text: words in windows of `width` words that stand twice or more in it, the first place included."""
    key, at = scan.windows(hashes, x.first, width)
    owner = x.owner()
    key = scan.mix(key + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # equal only within a text
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(hashes) + width + 1, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + width, -1)
    return scan.sums(np.cumsum(step)[: len(hashes)] > 0, x.first)


def counts(column: pa.Array) -> list[np.ndarray]:
    """COUNTS of each text of a slice."""
    x = scan.read(column)
    body = x.buf[: x.off[-1]]
    begins = (body & 0xC0) != 0x80  # one byte of each code point
    in_word = begins & ~scan.SPACES[body]
    repeats = np.array([duplicate_lines(bytes(body[a : b - 1])) for a, b in zip(x.off[:-1], x.off[1:])], np.int64)
    return [x.sizes, scan.sums(in_word, x.off), scan.sums(SYMBOLS[body], x.off), repeats, repeated_words(x, x.word_hashes())]


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source and COUNTS of every document."""

    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), *[pa.array(c, pa.int64()) for c in counts(column)]],
                    names=["doc_id", "source", *COUNTS],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def host_verdicts(hosts: DataFrame, limit: float) -> DataFrame:
    """source, n, failed -> also shrunk (the rate of failures after shrinking) and host_ok.

    Moments: with mean m and variance v of the hosts' rates, a + b = m (1 - m) / v - 1 pseudo-documents, never below 0.
    """
    rate = F.col("failed") / F.col("n")
    m, v, k = hosts.agg(F.avg(rate), F.var_samp(rate), F.count("*")).first()
    strength = max(m * (1 - m) / v - 1, 0.0) if k > 1 and v else 0.0
    shrunk = (F.col("failed") + (m or 0.0) * strength) / (F.col("n") + strength)
    return hosts.select("source", shrunk.alias("shrunk"), (shrunk <= limit).alias("host_ok"))


def judge(docs: DataFrame, limit: float = 0.5, min_words: int = 10, max_repeat_pct: int = 20) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, source, host_rate."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    rows = stage(document_counts(only(docs, "doc_id", "source", "text")).withColumn("base_failed", failed))
    hosts = stage(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")))
    verdict = host_verdicts(hosts, limit).withColumnRenamed("source", "host")
    return rows.join(verdict, rows["source"].eqNullSafe(verdict["host"]), "left").select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.col("host_ok")).alias("kept"), "source", F.round("shrunk", 6).alias("host_rate"),
    )


_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, sum(n - 1) AS n_dup_lines FROM (SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id, line) GROUP BY doc_id),
win AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM d WHERE len(words) >= 5),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i+4]) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice WHERE n >= 2) GROUP BY doc_id),
c AS (SELECT d.doc_id, d.source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS failed FROM b GROUP BY source),
m AS (SELECT avg(failed / n) AS m, var_samp(failed / n) AS v, count(*) AS k FROM h),
p AS (SELECT m, CASE WHEN k > 1 AND v > 0 THEN greatest(m * (1 - m) / v - 1, 0.0) ELSE 0.0 END AS strength FROM m),
s AS (SELECT source, (failed + m * strength) / (n + strength) AS shrunk FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND shrunk <= 0.5 AS kept, b.source, round(shrunk, 6) AS host_rate
FROM b LEFT JOIN s ON b.source IS NOT DISTINCT FROM s.source
"""


@query("op10_quality_rules", _SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
