"""Language-model scoring of whole documents: an exact unigram base, and a gated recurrent model.

1. Words of all training documents are counted (added up within a task, then shuffled by word hash).
2. The most frequent words, at most `hot` of them, are found by a histogram of counts and go to the tasks (a bounded 2 MB); so do the
   recurrent model's classes, which are cut from them by frequency.
3. Every task trains the model once over all its training documents, from the same start; the parameters (some 30 000 numbers) are
   averaged by trained tokens. No document is left out.
4. One pass scores all documents. Words outside the frequent ones are one class of the model; their counts come by a join of (word,
   document) rows with the counted words, which completes both scores.

Base: sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))). Score: the model's log10-probability of class and word, where
words without an output of their own share their class by (c + 0.1), and unseen words share one more 0.1.

Null or empty text: the end token alone. Null doc_id: training. Repeated rows: each counts and each is returned. No training
documents: N = V = 0, and score equals base_score. Empty table: no rows. Other columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm import gru, scan
from fleetprep.llm.tables import only, query, table

END = np.uint64(0x5E4D0C0FFEE0E4D5)  # stands for the end of a document among word hashes
HOT = 1 << 17
FLUSH = 1 << 21  # words a task holds before it passes its counts on
BLOCK = 3_000_000  # tokens that are laid out together
END_TOKEN, RARE_TOKEN = gru.TOKENS - 1, gru.TOKENS - 2


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys added up, in order."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def word_counts(docs: DataFrame) -> DataFrame:
    """h, c: the training tokens, ends included."""

    def run(batches):
        keys, counts, held = [], [], 0

        def out():
            k, c = merged(np.concatenate(keys), np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["h", "c"])

        for batch in batches:
            for _, _, column in scan.slices(batch.column("text")):
                h = np.sort(scan.read(column, True).word_hashes())
                first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, int)
                keys += [h[first], np.array([END])]
                counts += [np.diff(np.append(first, len(h))), np.array([len(column)])]
                held += len(first) + 1
                if held > FLUSH:
                    k, c = merged(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, held = [k], [c], len(k)
                    if held > FLUSH // 2:
                        yield out()
                        keys, counts, held = [], [], 0
        if keys:
            yield out()

    return docs.where("NOT held_out").select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The frequent words, sorted by hash: their counts, and their numbers in the model."""

    keys: np.ndarray
    counts: np.ndarray
    token: np.ndarray
    share: np.ndarray  # log10 of a word's part of its token
    token_counts: np.ndarray
    total: int
    distinct: int
    rare_mass: float

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words, and whether it is one."""
        if not len(self.keys):
            return np.zeros(len(h), int), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return at, self.keys[at] == h


def vocabulary(counts: DataFrame, hot: int = HOT) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # words by half octave of count: a few dozen rows
    octave = F.floor(F.log2("c") * 8)
    steps = sorted(counts.groupBy(octave.alias("o")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r["o"])
    least, n = None, 0
    for r in steps:
        n += r["n"]
        if n > hot:
            break
        least = r["c"]
    end = int(END.view(np.int64))
    keep = (F.col("h") == end) if least is None else (F.col("c") >= least) | (F.col("h") == end)
    rows = counts.where(keep).toArrow()
    keys, c = rows.column("h").to_numpy().view(np.uint64), rows.column("c").to_numpy()
    order = np.lexsort((keys, -c))
    order = np.concatenate((order[keys[order] != END], order[keys[order] == END]))  # by count, the end last
    keys, c = keys[order], c[order]
    words = len(keys) - 1 if len(keys) and keys[-1] == END else len(keys)
    token = np.full(len(keys), END_TOKEN)
    token[: min(words, gru.FRONT)] = np.arange(min(words, gru.FRONT))
    if words > gru.FRONT:  # classes of about equal weight
        c_tail = np.cumsum(c[gru.FRONT : words])
        token[gru.FRONT : words] = gru.FRONT + np.minimum((c_tail - 1) * (gru.TAIL - 2) // max(c_tail[-1], 1), gru.TAIL - 3)
    smooth = c + 0.1
    mass = np.bincount(token, smooth, gru.TOKENS)
    share = np.log10(smooth / mass[token])
    rare = total - c.sum() + 0.1 * (distinct - len(keys)) + 0.1
    mass[RARE_TOKEN] = rare
    by_key = np.argsort(keys)
    return Vocabulary(keys[by_key], c[by_key], token[by_key].astype(np.int32), share[by_key], mass, int(total), int(distinct), float(rare))


def tokens(x: scan.Texts, at: np.ndarray, known: np.ndarray, v: Vocabulary) -> list[np.ndarray]:
    """The model's tokens of each text, the end included."""
    token = np.where(known, v.token[at] if len(v.token) else 0, RARE_TOKEN).astype(np.int32)
    return [np.append(token[a:b], np.int32(END_TOKEN)) for a, b in zip(x.first[:-1], x.first[1:])]


def blocks(parts: Iterator, size: int = BLOCK) -> Iterator[list]:
    """Lists of (number of tokens, ...) with about `size` tokens together."""
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += p[0]
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def train(docs: DataFrame, v: Vocabulary, seed: int = 1) -> np.ndarray:
    """Parameters averaged over the tasks by the tokens they trained on."""
    start = gru.initial(v.token_counts, seed)

    def run(batches):
        def texts():
            for batch in batches:
                for _, _, column in scan.slices(batch.column("text")):
                    x = scan.read(column, True)
                    for t in tokens(x, *v.find(x.word_hashes()), v):
                        yield len(t), t

        trainer = gru.Trainer(start, END_TOKEN)
        for block in blocks(texts()):
            trainer.learn([t for _, t in block])
        if trainer.seen:
            weighted = np.append(trainer.flat.astype(np.float64) * trainer.seen, trainer.seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(weighted), dtype=np.int32)), pa.array(weighted)], names=["k", "w"])

    rows = docs.where("NOT held_out").select("text").mapInArrow(run, "k int, w double")
    found = rows.groupBy("k").agg(F.sum("w").alias("w")).toArrow()
    if not found.num_rows:
        return start
    out = np.zeros(gru.SIZE + 1)
    out[found.column("k").to_numpy()] = found.column("w").to_numpy()
    return (out[:-1] / out[-1]).astype(np.float32)


SCORED = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_rare long, h long, n long"


def scored(docs: DataFrame, v: Vocabulary, flat: np.ndarray) -> DataFrame:
    """Two kinds of rows: one per document (h null), and one per document and rare word (h, n)."""

    def run(batches):
        uid = TaskContext.get().partitionId() << 40

        def parts():
            for batch in batches:
                for lo, hi, column in scan.slices(batch.column("text")):
                    x = scan.read(column, True)
                    h = x.word_hashes()
                    at, known = v.find(h)
                    owner = x.owner()
                    logs = np.where(known, np.log10(v.counts[at] + 0.1) if len(v.counts) else 0.0, 0.0)
                    share = np.where(known, v.share[at] if len(v.share) else 0.0, 0.0)
                    head = v.token[at] < gru.FRONT if len(v.token) else known
                    base = np.bincount(owner, logs, len(column))
                    within = np.bincount(owner, np.where(head, 0.0, share), len(column))
                    n_known = scan.sums(known, x.first)
                    ids, held = (batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("doc_id", "held_out"))
                    for k, t in enumerate(tokens(x, at, known, v)):
                        a, b = x.first[k], x.first[k + 1]
                        yield len(t), t, ids[k], held[k], int(n_known[k]), base[k], within[k], h[a:b][~known[a:b]]

        for block in blocks(parts()):
            model = gru.score(flat, [p[1] for p in block], END_TOKEN)
            uids = np.arange(uid, uid + len(block))
            uid += len(block)
            n_tokens, n_known, n_rare = (np.array(c) for c in ([p[0] for p in block], [p[4] for p in block], [len(p[7]) for p in block]))
            none = pa.nulls(len(block), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), pa.array([p[2] for p in block], pa.int64()), pa.array([p[3] for p in block], pa.bool_()), pa.array(n_tokens), pa.array(n_known),
                 pa.array([p[5] for p in block], pa.float64()), pa.array(model + [p[6] for p in block]), pa.array(n_rare), none, none],
                names=[c.split()[0] for c in SCORED.split(", ")],
            )
            rare, owner = np.concatenate([p[7] for p in block]), np.repeat(np.arange(len(block)), n_rare)
            order = np.lexsort((rare, owner))
            rare, owner = rare[order], owner[order]
            first = np.flatnonzero(np.concatenate(([True], (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])))) if len(rare) else np.zeros(0, int)
            times = np.diff(np.append(first, len(rare)))
            none = [pa.nulls(len(first), t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(uids[owner[first]]), *none, pa.array(rare[first].view(np.int64)), pa.array(times)], names=[c.split()[0] for c in SCORED.split(", ")])

    return docs.mapInArrow(run, SCORED)


def score(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held.alias("held_out"))
    counts = stage(word_counts(docs))
    v = vocabulary(counts, hot)
    rows = stage(scored(docs, v, train(docs, v)))
    rare = rows.where("h IS NOT NULL").select("uid", "h", "n").join(counts, "h", "left")
    rare = rare.groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("logs"), F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("more"),
    )
    both = rows.where("h IS NULL").drop("h", "n").join(rare, "uid", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    ends = v.counts[v.keys == END]
    end_known, end_log = int(len(ends) > 0), float(np.log10((ends[0] if len(ends) else 0) + 0.1))
    base = F.col("base") + logs + F.lit(end_log) - F.col("n_tokens") * F.lit(float(np.log10(v.total + 0.1 * (v.distinct + 1))))
    model = F.col("score") + logs - F.col("n_rare") * F.lit(float(np.log10(v.rare_mass)))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0)) + end_known).alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"), base.alias("base_score"), (model if v.total else base).alias("score"),
    )


@query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
