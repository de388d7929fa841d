"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a maximal stretch of words with smallest period q that is at least max(LEAST, POWER * q) words long. Runs are found through suffix
trees: Ukkonen's tree of a word sequence and of its reversal, with lowest common ancestors from an Euler tour and a sparse table, answer in
constant time how far the words from two places on (or back) are the same. Every run holds a Lyndon root, a longest Lyndon
word at some place in one of the two orders of the alphabet, so extending each such candidate to both sides gives all runs.

In a run of that length every word stands POWER times or more, so a word that is rarer in a stretch is in no run and no run goes past
it. Texts are cut at such words again and again; trees are built of what is left, for most prose nothing. That loses no run.

A text is one row of work, in a single task. What a tree takes grows in proportion to its stretch, some 600 bytes a word at most, and the
sparse tables by a further factor of the logarithm. Null or blank text: no words, no runs, and the empty text collapsed. Null doc_id:
nothing is repeated by the query's rule. Repeated rows: each is returned. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.llm import scan
from fleetprep.llm.tables import only, plus, query, table

LEAST, POWER = 6, 4  # fixed values: the least length of a run, in words and in periods


class SuffixTree:
    """Ukkonen's suffix tree of numbers from 0 up; a last symbol, smaller than all, ends it."""

    def __init__(self, symbols: Sequence[int]):
        text = [x + 1 for x in symbols] + [0]
        n, width = len(text), max(text) + 1
        first, stop, link, step = [0], [0], [0], {}  # of each node: its edge's symbols and its suffix link; of (node, symbol): the child
        at, edge, length, todo = 0, 0, 0, 0  # the active point, and the suffixes still to add
        for i, symbol in enumerate(text):
            todo += 1
            made = 0  # the inner node that waits for its suffix link
            while todo:
                if not length:
                    edge = i
                child = step.get(at * width + text[edge])
                if child is None:
                    step[at * width + text[edge]] = len(first)
                    first.append(i)
                    stop.append(n)
                    link.append(0)
                    if made:
                        link[made] = at
                        made = 0
                else:
                    span = min(stop[child], i + 1) - first[child]
                    if length >= span:
                        edge, length, at = edge + span, length - span, child
                        continue
                    if text[first[child] + length] == symbol:
                        if made and at:
                            link[made] = at
                        length += 1
                        break
                    inner = len(first)
                    first += [first[child], i]
                    stop += [first[child] + length, n]
                    link += [0, 0]
                    step[at * width + text[edge]] = inner
                    step[inner * width + symbol] = inner + 1
                    first[child] += length
                    step[inner * width + text[first[child]]] = child
                    if made:
                        link[made] = inner
                    made = inner
                todo -= 1
                if not at and length:
                    length -= 1
                    edge = i - todo + 1
                elif at:
                    at = link[at]
        children: list[list[int]] = [[] for _ in first]
        for key in sorted(step):  # by node, then by symbol
            children[key // width].append(step[key])
        self.n = n - 1
        self._tour(children, first, stop, n)
        self.rank = self._ranks(children, first, stop, n, False)  # of each suffix, in the order of symbols
        self.back_rank = self._ranks(children, first, stop, n, True)  # in the opposite order; the end still comes first

    def _tour(self, children, first, stop, n) -> None:
        """The Euler tour: word depths of the nodes as they are met, each suffix's first place, and minima over powers of two."""
        depth = [0] * len(first)
        walk, place = [], [0] * n
        stack = [(0, 0)]
        while stack:
            node, k = stack.pop()
            if not k and node:
                if not children[node]:
                    place[n - depth[node]] = len(walk)
            walk.append(depth[node])
            if k < len(children[node]):
                child = children[node][k]
                depth[child] = depth[node] + min(stop[child], n) - first[child]
                stack.append((node, k + 1))
                stack.append((child, 0))
        self.place = np.array(place, np.int64)
        self.least = [np.array(walk, np.int32)]
        while 2 << (len(self.least) - 1) <= len(walk):
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def _ranks(self, children, first, stop, n, backwards: bool) -> np.ndarray:
        rank, order, stack = np.zeros(n, np.int64), 0, [(0, 0)]
        while stack:
            node, depth = stack.pop()
            depth += min(stop[node], n) - first[node] if node else 0
            if node and not children[node]:
                rank[n - depth] = order
                order += 1
            below = children[node]
            if backwards and below and first[below[0]] == n - 1:
                below = [*below[1:], below[0]]
            for child in below if backwards else reversed(below):
                stack.append((child, depth))
        return rank

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at i and j begin with in common; i and j differ, up to n (the empty suffix)."""
        a, b = np.minimum(self.place[i], self.place[j]), np.maximum(self.place[i], self.place[j]) + 1
        level = np.frexp(b - a)[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            pick = level == k
            out[pick] = np.minimum(self.least[k][a[pick]], self.least[k][b[pick] - (1 << int(k))])
        return out


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word that starts at each place ends: the next place with a smaller suffix."""
    order, n = rank.tolist(), len(rank) - 1
    out, stack = [n] * n, []
    for i in range(n):
        mine = order[i]
        while stack and order[stack[-1]] > mine:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def all_runs(symbols: Sequence[int]) -> np.ndarray:
    """Rows (start, length, period) of every maximal repetition of two periods or more, by start and period."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    ahead, behind = SuffixTree(symbols), SuffixTree(symbols[::-1])
    i = np.concatenate((np.arange(n), np.arange(n)))
    j = np.concatenate((lyndon_ends(ahead.rank), lyndon_ends(ahead.back_rank)))
    period = j - i
    right = np.zeros(2 * n, np.int64)
    inside = j < n
    right[inside] = ahead.common(i[inside], j[inside])
    left = behind.common(n - i, n - j)
    found = left + right >= period
    rows = np.column_stack((i - left, period + left + right, period))[found]
    return np.unique(rows, axis=0)[:, [0, 1, 2]] if len(rows) else rows


def stretches(symbols: np.ndarray, power: int = POWER, least: int = LEAST) -> list[tuple[int, int]]:
    """Parts outside of which no run can lie: every word in a part stands `power` times or more in it."""
    out, todo = [], [(0, len(symbols))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < least:
            continue
        part = symbols[lo:hi]
        _, back, count = np.unique(part, return_inverse=True, return_counts=True)
        rare = np.flatnonzero(count[back] < power)
        if not len(rare):
            out.append((lo, hi))
            continue
        edges = np.concatenate(([-1], rare, [hi - lo]))
        todo += [(lo + int(a) + 1, lo + int(b)) for a, b in zip(edges[:-1], edges[1:]) if b - a > least]
    return sorted(out)


def runs(symbols: np.ndarray, power: int = POWER, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence, by start, then period."""
    found = [np.zeros((0, 3), np.int64)]
    for lo, hi in stretches(symbols, power, least):
        _, small = np.unique(symbols[lo:hi], return_inverse=True)
        rows = all_runs(small.tolist())
        rows = rows[rows[:, 1] >= np.maximum(least, power * rows[:, 2])]
        rows[:, 0] += lo
        found.append(rows)
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept(n: int, rows: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, rows[:, 0] + rows[:, 2], 1)
    np.add.at(step, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(step[:n]) == 0


def words_of(text: str) -> list[bytes]:
    return text.encode().split()  # for bytes, \x20 and \x09 to \x0D are the white space


def numbered(words: Sequence[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The query's rule: in a tenth of the documents, words from some place on repeat with some period."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def collapse(docs: DataFrame, column: str = "text") -> DataFrame:
    """docs with `runs` (start, length, period) and `collapsed`, the words that stay joined by one space."""

    def run(batches):
        for batch in batches:
            for lo, hi, texts in scan.slices(batch.column(column)):
                found, left = [], []
                for text in texts.to_pylist():
                    words = words_of(text)
                    rows = runs(numbered(words))
                    found.append([dict(zip(("start", "length", "period"), r)) for r in rows.tolist()])
                    left.append(b" ".join([words[k] for k in np.flatnonzero(kept(len(words), rows))]).decode())
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays(
                    [c.slice(lo, hi - lo) for c in batch.columns] + [pa.array(found, kind), pa.array(left, pa.string())], names=[*batch.schema.names, "runs", "collapsed"]
                )

    docs = docs.drop("runs", "collapsed")
    return docs.mapInArrow(run, plus(docs.schema, "runs array<struct<start:long,length:long,period:long>>, collapsed string"))


DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def digest(words: list[bytes]) -> tuple:
    """The columns of DIGESTS after doc_id."""
    rows = runs(numbered(words))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows.tolist())
    left = b" ".join(words if not len(rows) else [words[k] for k in np.flatnonzero(kept(len(words), rows))])
    s, n, q = min(rows.tolist(), key=lambda r: (-r[1], r[0], r[2])) if len(rows) else (None, None, None)
    return len(rows), s, n, q, None if q is None else 1000 * n // q, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()


def digests(docs: DataFrame) -> DataFrame:
    """The DIGESTS of every document, after the query's rule has repeated some of its words."""

    def run(batches):
        for batch in batches:
            for lo, hi, texts in scan.slices(batch.column("text")):
                ids = batch.column("doc_id").slice(lo, hi - lo)
                found = [(d, *digest(repeated(words_of(t), d))) for d, t in zip(ids.to_pylist(), texts.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if k < 6 else pa.string()) for k, c in enumerate(zip(*found))], names=[c.split()[0] for c in DIGESTS.split(", ")]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, DIGESTS)


@query("op13_period_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(only(table(spark, sf_dir, "documents"), "doc_id", "text"))
