"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on the statistics (STATS) of labelled documents outside the held-out fold; about `max_train` of them, drawn by a hash
of the doc_id, go to the driver (a documented bound: 20 000 rows of 16 numbers). The forest is flattened to five arrays (feature,
threshold, first child, value, roots) of a few thousand entries. One pass over all whole texts then takes the statistics of every
document and scores it by walking all trees at once in numpy.

Labels, language, source and doc_id are no inputs of a score. Null and empty texts are scored as texts without words. Null doc_id:
never labelled, not held out. Label rows without a quality are ignored; of several labels of a document the largest counts. If no or
only one class is labelled there is nothing to learn and every score is the share of label 1 (0.5 without labels). Repeated
rows are each returned. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import small_batches
from fleetprep.llm import scan
from fleetprep.llm.quality_rules import SYMBOLS, duplicate_lines, repeated_words
from fleetprep.llm.tables import only, query, table

STATS = [
    "log_words", "word_bytes", "upper", "digits", "symbols", "stops", "marks", "non_ascii", "lines", "words_a_line", "dup_lines",
    "repeats", "adjacent", "distinct", "one_word_lines", "spaces",
]
UPPER, DIGIT, STOP, MARK = (np.zeros(256, bool) for _ in range(4))
UPPER[65:91] = DIGIT[48:58] = True
STOP[list(b".,;:")] = True
MARK[list(b"!?\"'()-_=+~/\\@[]{}^`")] = True


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATS for each text of a slice."""
    x = scan.read(column)
    h, n = x.word_hashes(), x.sizes
    body = x.buf[: x.off[-1]]
    size, words = np.maximum(np.diff(x.off) - 1, 1), np.maximum(n, 1)
    count = lambda flags: scan.sums(flags, x.off)
    line_end = np.flatnonzero(body == 10)
    words_in_line = np.diff(np.concatenate(([0], np.searchsorted(x.start, line_end))))
    line_off = np.searchsorted(line_end, x.off)
    filled = np.maximum(scan.sums(words_in_line > 0, line_off), 1)
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[x.first[:-1][n > 0]] = False
    distinct = np.array([1 + np.count_nonzero(np.diff(np.sort(h[a:b]))) if b > a else 0 for a, b in zip(x.first[:-1], x.first[1:])])
    repeats = np.array([duplicate_lines(bytes(body[a : b - 1])) for a, b in zip(x.off[:-1], x.off[1:])])
    return np.column_stack([
        np.log1p(n), scan.sums(x.end - x.start, x.first) / words, count(UPPER[body]) / size, count(DIGIT[body]) / size,
        count(SYMBOLS[body]) / size, count(STOP[body]) / size, count(MARK[body]) / size, count(body >= 128) / size, np.log1p(filled),
        n / filled, repeats / filled, repeated_words(x, h) / words, scan.sums(same, x.first) / words, distinct / words,
        scan.sums(words_in_line == 1, line_off) / filled, count(scan.SPACES[body]) / (size + 1),
    ])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, y and STATS of every document."""

    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                stats = statistics(column)
                own = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "y")]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(s) for s in stats.T.astype(np.float64)]], names=["doc_id", "y", *STATS])

    return docs.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y double, " + ", ".join(f"{s} double" for s in STATS))


@dataclass
class Forest:
    """All trees in common arrays; a node with feature -1 is a leaf, the second child follows the first."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of x."""
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[node]
            right = x[row, np.maximum(f, 0)] > self.threshold[node]
            node = np.where(f < 0, node, self.child[node] + right)
        return 1 / (1 + np.exp(-(self.start + self.value[node].sum(axis=1))))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: int = 20) -> Forest:
    """Boosted trees on logistic loss; splits are sought in histograms of at most `bins` bins per feature."""
    n, width = x.shape
    feature, threshold, child, value, roots = [], [], [], [], []
    share = y.mean() if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        empty = np.zeros(0, int)
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Forest(empty, np.zeros(0), empty, np.zeros(0), empty, 0, float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])  # bin b: x <= edges[b]
    cell = binned + np.arange(width) * bins
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        base = len(feature)
        roots.append(base)
        feature.append(-1), threshold.append(0.0), child.append(0), value.append(rate * g.sum() / (h.sum() + l2))
        at = np.full(n, base)
        level = [base]
        for _ in range(depth):
            if not level:
                break
            slot = np.full(len(feature) - base, -1)
            slot[np.array(level) - base] = np.arange(len(level))
            mine = slot[at - base]
            live = np.flatnonzero(mine >= 0)
            flat = (mine[live][:, None] * (width * bins) + cell[live]).ravel()
            shape = (len(level), width, bins)
            sums = [np.bincount(flat, np.repeat(w[live], width), len(level) * width * bins).reshape(shape).cumsum(2) for w in (g, h, np.ones(n))]
            (gl, hl, nl), (ga, ha, na) = sums, [s[:, :1, -1:] for s in sums]
            gain = gl**2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga**2 / (ha + l2)
            gain = np.where((nl >= least) & (na - nl >= least), gain, 0.0).reshape(len(level), -1)
            best = gain.argmax(1)
            after = []
            for k, node in enumerate(level):
                f, b = divmod(int(best[k]), bins)
                if gain[k, best[k]] <= 1e-9 or b >= len(edges[f]):
                    continue
                first = len(feature)
                feature[node], threshold[node], child[node] = f, float(edges[f][b]), first
                for gs, hs in ((gl[k, f, b], hl[k, f, b]), (ga[k, 0, 0] - gl[k, f, b], ha[k, 0, 0] - hl[k, f, b])):
                    feature.append(-1), threshold.append(0.0), child.append(0), value.append(rate * gs / (hs + l2))
                after += [first, first + 1]
                rows = live[mine[live] == k]
                at[rows] = first + (binned[rows, f] > b)
            level = after
        margin += np.array(value[base:])[at - base]
    return Forest(np.array(feature), np.array(threshold), np.array(child), np.array(value), np.array(roots), depth, start)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> Forest:
    """A forest from about max_train labelled documents (all, if there are fewer) outside the held-out fold."""
    labels = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("quality").cast("double"))
    labels = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("y"))
    share = min(1.0, max_train / max(labels.count(), 1))
    drawn = labels.where(F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit("train")), 32) < int(share * 2**32))
    rows = docs.join(F.broadcast(drawn), "doc_id")  # bounded by max_train
    data = document_statistics(rows).toPandas().sort_values(["doc_id", "y", *STATS])
    return grow(data[STATS].to_numpy(np.float64), (data["y"].to_numpy() > 0.5).astype(np.float64))


def plain(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def score(docs: DataFrame, labels: DataFrame, at_least: float = 0.3, max_train: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs = plain(docs)
    forest = fit(docs, only(labels, "doc_id", "quality"), max_train)

    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(forest.scores(statistics(column)))], names=["doc_id", "score"])

    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= at_least).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, at_least: float = 0.3, max_train: int = 20_000) -> DataFrame:
    """The documents that score at_least or more, with all their columns; nothing is shuffled."""
    small_batches(docs.sparkSession)
    forest = fit(plain(docs), only(labels, "doc_id", "quality"), max_train)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column(at)):  # a slice at a time is passed on, which bounds what a worker holds
                yield batch.slice(lo, hi - lo).filter(pa.array(forest.scores(statistics(column)) >= at_least))

    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # column names may hold dots
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
