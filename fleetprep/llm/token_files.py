"""Token ids in files compressed by pair grammars (Re-Pair), with random access.

Documents are ordered by doc_id over all files. A task encodes its documents and cuts them into shards of about a million ids. In each
shard, frequent pairs of neighbouring ids are replaced by new ids (nonterminals) again and again; a round counts all pairs,
takes the most frequent ones together, and replaces their occurrences from left to right where they do not overlap. Pairs do not reach over
the end of a document, so each document is a run of codes of its own. A shard stores its rules, the number of ids that each
nonterminal stands for, the codes (16 bits), and each document's first code and number of ids: a range of ids of one document is
read by adding up lengths and expanding only the codes it touches.

File format: Parquet, one row per shard (columns in FORMAT; the binaries are little-endian arrays). It is written and read by
Spark alone, so that any store will do.

A word of a text (between ASCII white space) is always encoded alike, since the tokenizer drops white space before it splits; so each
task encodes a word once and keeps its ids, for at most `KEEP` words.

Null or empty text: only the end id. Null doc_id: first in order. Repeated doc_ids follow each other, ordered by a hash of the
text. A document is never split; one that is longer than a shard is a shard. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import shared_folder
from fleetprep.llm import scan
from fleetprep.llm.tables import only, query, table

END_ID = 2
SHARD = 1_000_000
CODES = 1 << 16
ROUNDS = 4
LEAST = 4  # occurrences of a pair that pay for a rule
KEEP = 1_000_000
FORMAT = (
    "part int, shard int, first_doc long, first_tie long, first_token long, n_tokens long, base int, doc_ids array<long>, doc_tokens binary, "
    "doc_codes binary, rules binary, lengths binary, codes binary"
)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] ... starts[i] + sizes[i] - 1, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


#: kinds of bytes: letter, digit, other ASCII mark, and 0 for what is not known from the byte alone (an apostrophe begins endings)
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[48:58] = 2
KINDS[[b for b in range(0x21, 0x7F) if not KINDS[b] and b != 0x27]] = 3
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
TOGETHER = 50  # words that are encoded in one call


@cache
def library(path: str):
    """The tokenizer, read once by each worker process: a worker that reads it for every task grows by some 4 MB a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of words, each encoded once. The tokenizer lower-cases, and parts letters, digits and marks, so words are taken in lower case
    (unless the text may hold a special token) and cut where the kind of ASCII or Latin-1 characters changes; digits stand alone."""

    def __init__(self, path: str):
        self.tokenizer = library(path)
        from tokenizers import pre_tokenizers

        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spell(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.sizes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and the number of ids of each.

        Words of small Latin-1 letters go to the library's model at once, in its spelling of bytes: its normaliser and splitter leave
        them as they are. Other words of letters go through the whole library many at a time: they are one piece each, which it
        numbers; if the numbers do not fit, they go one by one, as all others.
        """
        plain, letters, single = [], [], []
        for k, w in enumerate(words):
            (plain if PLAIN.fullmatch(w) else letters if w.isalpha() else single).append(k)
        tokenize = self.tokenizer.model.tokenize
        owner, ids = [], []

        def add(which: list[int], found: list[list[int]]) -> None:
            times = np.fromiter(map(len, found), np.int64, len(found))
            owner.append(np.repeat(np.array(which, np.int64), times))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint16, int(times.sum())))

        add(plain, [[t.id for t in tokenize(words[k] if words[k].isascii() else words[k].translate(self.spelling))] for k in plain])
        groups = [letters[k : k + TOGETHER] for k in range(0, len(letters), TOGETHER)]
        for group, e in zip(groups, self.tokenizer.encode_batch([" ".join([words[k] for k in g]) for g in groups], add_special_tokens=False)):
            number = np.array(e.word_ids, np.int64)
            if len(number) and number[0] == 0 and number[-1] == len(group) - 1 and np.isin(np.diff(number), (0, 1)).all():
                owner.append(np.array(group)[number]), ids.append(np.array(e.ids, np.uint16))
            else:
                single += group
        add(single, [e.ids for e in self.tokenizer.encode_batch_fast([words[k] for k in single], add_special_tokens=False)])
        owner, ids = np.concatenate(owner), np.concatenate(ids)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def places(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where each word is kept; new ones are encoded."""
        h = scan.span_hashes(buf, start, end)
        if len(self.keys) > KEEP:
            self.forget()
        order = np.argsort(h)
        new_run = np.concatenate(([True], h[order[1:]] != h[order[:-1]])) if len(h) else np.zeros(0, bool)
        first = order[new_run]
        place = np.minimum(np.searchsorted(self.keys, h[first]), max(len(self.keys) - 1, 0))
        new = first if not len(self.keys) else first[self.keys[place] != h[first]]
        if len(new):
            data = buf.tobytes()
            ids, sizes = self.ids_of([data[a:b].decode("utf-8", "replace") for a, b in zip(start[new].tolist(), end[new].tolist())])
            at = len(self.ids) + np.cumsum(sizes) - sizes
            self.ids = np.concatenate((self.ids, ids))
            keys = np.concatenate((self.keys, h[new]))
            by_key = np.argsort(keys)
            self.keys, self.at, self.sizes = keys[by_key], np.concatenate((self.at, at))[by_key], np.concatenate((self.sizes, sizes))[by_key]
            place = np.searchsorted(self.keys, h[first])
        out = np.empty(len(h), np.int64)
        out[order] = place[np.cumsum(new_run) - 1]
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and the number of ids of each."""
        x = scan.read(column)
        start, end = x.start, x.end
        if x.buf.tobytes().find(b"<|") < 0:  # no special token
            x = scan.read(column, True)
            kind = KINDS[x.buf]
            latin = np.flatnonzero(x.buf == 0xC3)  # A-grave to y-diaeresis, all letters but for the signs of multiplication and division
            latin = latin[~np.isin(x.buf[latin + 1], (0x97, 0xB7))]
            kind[latin] = kind[latin + 1] = 1
            cut = np.flatnonzero((kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))) + 1
            start, end = np.sort(np.concatenate((start, cut))), np.sort(np.concatenate((end, cut)))
        first = np.searchsorted(start, x.off)
        word = self.places(x.buf, start, end)
        at, sizes = np.insert(self.at[word], first[1:], len(self.ids)), np.insert(self.sizes[word], first[1:], 1)
        ids = np.append(self.ids, np.uint16(END_ID))[ragged(at, sizes)]
        return ids, scan.sums(sizes, first + np.arange(len(first)))


SLOT_BITS = 18


def slots_of(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)


def compress(ids: np.ndarray, sizes: np.ndarray, base: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, the number of codes of each document, and rules: pairs of codes, for nonterminals base, base + 1, ...

    Pairs are found by a table with one pair a slot; of frequent pairs that meet in a slot, the most frequent one gets a rule in this round.
    """
    seq, last = ids.astype(np.uint32), np.zeros(len(ids), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    rules = np.zeros(0, np.uint32)
    for left in range(rounds, 0, -1):
        free = (CODES - base - len(rules)) // left
        pair = (seq[:-1] << np.uint32(16)) | seq[1:]
        inside = ~last[:-1]
        ordered = np.sort(pair[inside])
        if not len(ordered) or free <= 0:
            break
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(first, len(ordered)))
        often = np.flatnonzero(counts >= LEAST)
        often = often[np.argsort(-counts[often], kind="stable")[:free]]
        if not len(often):
            break
        chosen = ordered[first[often]]
        rule_in = np.zeros(1 << SLOT_BITS, np.uint16)
        rule_in[slots_of(chosen[::-1])] = np.arange(len(chosen))[::-1]  # the most frequent pair is written last
        rule = rule_in[slots_of(pair)]
        at = np.flatnonzero((chosen[rule] == pair) & inside)
        # in a run of overlapping pairs every other one is taken, from the left
        begins = np.concatenate(([True], at[1:] != at[:-1] + 1))
        run = np.maximum.accumulate(np.where(begins, at, 0))
        at = at[(at - run) % 2 == 0]
        seq[at] = base + len(rules) + rule[at].astype(np.uint32)
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        rules = np.concatenate((rules, chosen))
    ends = np.flatnonzero(last) + 1
    n_codes = np.zeros(len(sizes), np.int64)
    n_codes[sizes > 0] = np.diff(ends, prepend=0)
    return seq.astype(np.uint16), n_codes, np.column_stack((rules >> np.uint32(16), rules & np.uint32(0xFFFF))).astype(np.uint16)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """The number of ids that each nonterminal stands for; rules only name what came before them."""
    out = np.ones(base + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        out[base + k] = out[a] + out[b]
    return out[base:]


def expand(codes: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that codes stand for: all nonterminals are replaced by their pairs until none is left."""
    codes = codes.astype(np.int64)
    while True:
        inner = codes >= base
        if not inner.any():
            return codes
        at = np.cumsum(1 + inner) - (1 + inner)
        out = np.empty(int(len(codes) + inner.sum()), np.int64)
        out[at[~inner]] = codes[~inner]
        pair = rules[codes[inner] - base]
        out[at[inner]], out[at[inner] + 1] = pair[:, 0], pair[:, 1]
        codes = out


class Shard:
    """A shard as it is read: whole documents, or ranges of one."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.doc_ids = row["doc_ids"]
        self.doc_tokens, self.doc_codes = np.frombuffer(row["doc_tokens"], "<i8"), np.frombuffer(row["doc_codes"], "<i8")
        self.rules, self.codes = np.frombuffer(row["rules"], "<u2").reshape(-1, 2), np.frombuffer(row["codes"], "<u2")
        self.lengths = np.frombuffer(row["lengths"], "<i8")

    def ids(self) -> np.ndarray:
        return expand(self.codes, self.rules, self.base)

    def ids_of(self, k: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids lo to hi of the shard's k-th document."""
        codes = self.codes[self.doc_codes[k] : self.doc_codes[k + 1]]
        hi = int(self.doc_tokens[k]) if hi is None else min(hi, int(self.doc_tokens[k]))
        length = np.where(codes < self.base, 1, self.lengths[np.maximum(codes.astype(int) - self.base, 0)] if len(self.lengths) else 1)
        ends = np.cumsum(length)
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return expand(codes[a:b], self.rules, self.base)[lo - before : max(hi, lo) - before]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, shard: int = SHARD) -> None:
    """Encode all documents and write shards in ascending doc_id order."""

    def run(batches):
        encoder, part, number, first_token = Encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        held: list = []

        def flush():
            nonlocal number, first_token, held
            ids, sizes = np.concatenate([h[2] for h in held]), np.array([len(h[2]) for h in held])
            codes, n_codes, rules = compress(ids, sizes, encoder.vocabulary)
            row = (
                part, number, held[0][0], held[0][1], first_token, len(ids), encoder.vocabulary, [h[0] for h in held], sizes.astype("<i8").tobytes(),
                np.concatenate(([0], np.cumsum(n_codes))).astype("<i8").tobytes(), rules.astype("<u2").tobytes(),
                expansion_lengths(rules, encoder.vocabulary).astype("<i8").tobytes(), codes.astype("<u2").tobytes(),
            )
            number, first_token, held = number + 1, first_token + len(ids), []
            types = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=[c.split()[0] for c in FORMAT.split(", ")])

        waiting = 0
        for batch in batches:
            for lo, hi, column in scan.slices(batch.column("text")):
                ids, sizes = encoder.encode(column)
                docs_in, ties = (batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("doc_id", "tie"))
                for doc, tie, one in zip(docs_in, ties, np.split(ids, np.cumsum(sizes)[:-1])):
                    held.append((doc, tie, one))
                    waiting += len(one)
                    if waiting >= shard:
                        yield flush()
                        waiting = 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows.mapInArrow(run, FORMAT).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    shards = spark.read.parquet(path)
    # one row per task that wrote: where its ids begin among all ids
    parts = shards.groupBy("part").agg(F.min(F.struct(F.col("first_doc").isNotNull(), "first_doc", "first_tie")).alias("first"), F.sum("n_tokens").alias("n")).collect()
    begin, total = [], 0
    for r in sorted(parts, key=lambda r: (r["first"][0], r["first"][1] or 0, r["first"][2], r["part"])):
        begin.append((r["part"], total))
        total += r["n"]
    begin = spark.createDataFrame(begin, "part int, part_start long")
    shards = shards.join(F.broadcast(begin), "part").withColumn("first_token", F.col("first_token") + F.col("part_start"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                s = Shard(row)
                ends = np.cumsum(s.doc_tokens)
                ids = s.ids().astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - s.doc_tokens).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids, pa.int64()), pa.array(row["first_token"] + ends - s.doc_tokens), pa.array(s.doc_tokens), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' ids to the shared folder and read the files back."""
    spark = docs.sparkSession
    path = os.path.join(shared_folder(spark), "tokens-" + uuid.uuid4().hex)
    write_tokens(only(docs, "doc_id", "text"), path, tokenizer)
    return read_tokens(spark, path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_token_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), tokenizer_path())
