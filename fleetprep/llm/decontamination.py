"""Benchmark decontamination: rare n-gram seeds join training passages to test items, Smith-Waterman alignment scores them.

Words are runs of a-z (A-Z lower-cased), digits and non-ASCII characters, so that case and punctuation do not matter. Items are cut
into pieces of at most 128 words. A piece's seeds are its 3-word sequences; one pass over all texts counts the documents that hold each.
A seed is rare if at most 1 % of all documents hold it, or if it is in the rarer half of its piece's seeds, so that an item copied into
many documents keeps its seeds. A second pass cuts out the passages around rare seeds, with room for a whole piece on both
sides; passages meet pieces in a join on the seed. Each (passage, piece) is aligned once: match +2, mismatch -1, gap -1, local. The
score is the best alignment over twice the piece's words: 1 for an exact copy, about 0.63 with a quarter of the words replaced.

Both passes filter by a bitmap of fixed size; the join is exact. A result names (doc_id, item_id) with the best passage, for scores
of at least `least`, or any score if the alignment is worth `enough` matching words. It must be worth 6 matching words, or all words
of a shorter item.

Null or empty texts and items: no words, no results. Items of fewer than 3 words have no seeds. Repeated item rows count once, and
so do items that repeat under one item_id. Null doc_id or item_id: kept as null. Repeated documents give one result. Empty
tables: no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm import scan
from fleetprep.llm.bitmaps import bitmap, within
from fleetprep.llm.tables import only, query, table

SEED = 3
PIECE = 128
ROOM = PIECE + PIECE // 4
CLUSTER = 512  # a passage's hits span at most so many words
PARTS = np.zeros(256, bool)
PARTS[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
MATCH, MISMATCH, GAP = 2, 1, 1


def seeds_of(items: DataFrame) -> DataFrame:
    """item_id, piece (hash of its words), words, n (words of the item), h: one row per seed of a piece."""

    def run(batches):
        for batch in batches:
            rows = []
            for lo, hi, column in scan.slices(batch.column("text")):
                x = scan.read(column, True, PARTS)
                h = x.word_hashes()
                for item, a, b in zip(batch.column("item_id").slice(lo, hi - lo).to_pylist(), x.first[:-1], x.first[1:]):
                    for at in range(a, b, PIECE):
                        w = h[at : min(at + PIECE, b)]
                        grams, _ = scan.windows(w, np.array([0, len(w)]), SEED)
                        grams = grams[np.sort(np.unique(grams, return_index=True)[1])]
                        rows += [(item, w.view(np.int64).tolist(), int(b - a), int(g)) for g in grams.view(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                names=["item_id", "words", "n", "h"],
            )

    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    return items.mapInArrow(run, "item_id long, words array<long>, n long, h long").withColumn("piece", F.xxhash64("item_id", "words"))


def seed_counts(docs: DataFrame, seen: np.ndarray) -> DataFrame:
    """h, docs: documents that hold a seed, added up within a task first; n_docs is in the row with h null."""

    def run(batches):
        found, n = {}, 0
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                x = scan.read(column, True, PARTS)
                grams, at = scan.windows(x.word_hashes(), x.first, SEED)
                hit = within(seen, grams)
                owner = x.owner()[at[hit]] if len(at) else at
                for _, g in set(zip(owner.tolist(), grams[hit].view(np.int64).tolist())):
                    found[g] = found.get(g, 0) + 1
                n += hi - lo
        yield pa.RecordBatch.from_arrays([pa.array([*found, None], pa.int64()), pa.array([*found.values(), n], pa.int64())], names=["h", "docs"])

    return docs.mapInArrow(run, "h long, docs long").groupBy("h").agg(F.sum("docs").alias("docs"))


def rare_seeds(seeds: DataFrame, counts: DataFrame, common_share: float) -> DataFrame:
    n_docs = (counts.where("h IS NULL").agg(F.max("docs")).first()[0] or 0) * common_share
    known = seeds.join(counts.where("h IS NOT NULL"), "h").withColumn("n_seeds", F.lit(1))
    # the rarer half: by rank within the piece (a piece has at most PIECE seeds)
    ranks = known.groupBy("piece").agg(F.array_sort(F.collect_list(F.struct("docs", "h"))).alias("all"))
    known = known.join(ranks, "piece").withColumn("rank", F.array_position("all", F.struct("docs", "h")))
    return known.where((F.col("docs") <= n_docs) | (2 * F.col("rank") <= F.size("all") + 1)).select("item_id", "piece", "words", "n", "h")


def passages(docs: DataFrame, seen: np.ndarray) -> DataFrame:
    """doc_id, first (place of the passage), passage (its words), hits (seeds in it)."""

    def run(batches):
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                x = scan.read(column, True, PARTS)
                h = x.word_hashes()
                grams, at = scan.windows(h, x.first, SEED)
                hit = within(seen, grams)
                grams, at = grams[hit].view(np.int64), at[hit]
                owner = x.owner()[at] if len(at) else at
                ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                # a new passage where the document changes, after a gap, or when it gets long
                far = np.ones(len(at), bool)
                far[1:] = (owner[1:] != owner[:-1]) | (at[1:] - at[:-1] > ROOM)
                begin = at[np.maximum.accumulate(np.where(far, np.arange(len(at)), 0))] if len(at) else at
                far[1:] |= (at[1:] - begin[1:]) // CLUSTER != (at[:-1] - begin[:-1]) // CLUSTER
                cut = [*np.flatnonzero(far), len(at)]
                rows = []
                for a, b in zip(cut[:-1], cut[1:]):
                    d = owner[a]
                    first, last = max(at[a] - ROOM, x.first[d]), min(at[b - 1] + SEED + ROOM, x.first[d + 1])
                    rows.append((ids[d], int(first - x.first[d]), h[first:last].view(np.int64).tolist(), sorted(set(grams[a:b].tolist()))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                    names=["doc_id", "first", "passage", "hits"],
                )

    return docs.mapInArrow(run, "doc_id long, first long, passage array<long>, hits array<long>")


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each pair: its value, and the place of its last word in the text."""
    n, wide, deep = len(items), max(map(len, texts), default=0), max(map(len, items), default=0)
    if not n or not wide or not deep:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    text, item = np.zeros((n, wide), np.int64), np.zeros((n, deep), np.int64)
    in_text, in_item = np.zeros((n, wide), bool), np.zeros((n, deep), bool)
    for k, (i, t) in enumerate(zip(items, texts)):
        text[k, : len(t)], in_text[k, : len(t)], item[k, : len(i)], in_item[k, : len(i)] = t, True, i, True
    ramp = GAP * np.arange(wide, dtype=np.int32)
    row, best, where = np.zeros((n, wide), np.int32), np.zeros(n, np.int32), np.zeros(n, np.int64)
    for k in range(deep):
        same = (text == item[:, k : k + 1]) & in_text & in_item[:, k : k + 1]
        new = np.where(same, MATCH, -MISMATCH).astype(np.int32)
        new[:, 1:] += row[:, :-1]
        new = np.maximum(np.maximum(new, row - GAP), 0)
        row = np.maximum.accumulate(new + ramp, axis=1) - ramp
        top = row.argmax(axis=1)
        value = row[np.arange(n), top]
        where = np.where(value > best, top, where)
        best = np.maximum(best, value)
    return best.astype(np.int64), where


def aligned(pairs: DataFrame, least: float, words: int, enough: int, together: int = 256) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word of pairs that reach `least` or `enough`."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, together):
                part = batch.slice(lo, together)
                column = lambda name: [np.asarray(v, np.int64) for v in part.column(name).to_pylist()]
                items, texts = column("words"), column("passage")
                best, last = align(items, texts)
                score = best / (MATCH * np.maximum([len(i) for i in items], 1))
                whole = np.asarray(part.column("n"), np.int64)
                ok = np.flatnonzero(((score >= least) | (best >= MATCH * enough)) & (best >= MATCH * np.minimum(words, whole)))
                # where it begins: the same alignment from the back
                back, end = align([items[k][::-1] for k in ok], [texts[k][: last[k] + 1][::-1] for k in ok])
                first = np.array(part.column("first").to_pylist(), np.int64)[ok]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(ok)), part.column("item_id").take(pa.array(ok)), pa.array(score[ok], pa.float64()), pa.array(first + last[ok] - end, pa.int64()), pa.array(first + last[ok], pa.int64())],
                    names=["doc_id", "item_id", "score", "first_word", "last_word"],
                )

    return pairs.mapInArrow(run, "doc_id long, item_id long, score double, first_word long, last_word long")


def contaminated(docs: DataFrame, items: DataFrame, least: float = 0.5, words: int = 6, enough: int = 25, common_share: float = 0.01) -> DataFrame:
    """One row per (doc_id, item_id) that match: score (0 to 1), first_word, last_word (places in the document)."""
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    seeds = stage(seeds_of(only(items, "item_id", "text")))
    counts = stage(seed_counts(docs, bitmap(seeds, "h")))
    rare = stage(rare_seeds(seeds, counts, common_share))
    cuts = stage(passages(docs, bitmap(rare, "h")).withColumn("cut", F.xxhash64("doc_id", "first", "passage")))
    meet = cuts.select("cut", F.explode("hits").alias("h")).join(rare.select("h", "piece"), "h").select("cut", "piece").distinct()
    pieces = rare.groupBy("piece").agg(F.first("item_id").alias("item_id"), F.first("words").alias("words"), F.min("n").alias("n"))
    texts = cuts.select("cut", "doc_id", "first", "passage").dropDuplicates(["cut"])
    pairs = meet.join(texts, "cut").join(pieces, "piece")
    hits = aligned(pairs.select("doc_id", "first", "passage", "item_id", "words", "n"), least, words, enough)
    best = F.max(F.struct("score", -F.col("first_word"), -F.col("last_word"))).alias("b")
    hits = hits.groupBy("doc_id", "item_id").agg(best)
    return hits.select("doc_id", "item_id", F.round("b.score", 6).alias("score"), (-F.col("b.col2")).alias("first_word"), (-F.col("b.col3")).alias("last_word"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
