"""N-gram Jaccard join: sparse product of the document by n-gram incidence, in blocks of columns, with size-derived bounds.

A document's row in the incidence matrix is its set of distinct 5-word shingles (64-bit hashes). Documents with equal sets are one
class (a 64-bit fingerprint of the set), so copies cost one row. Two classes link when 100 * intersection >= 75 * union, that is when
they share at least 3 (n + m) / 7 shingles.

Only part of the matrix is multiplied out. All shingles are put into one global order, and of each row only the first
n - ceil(3n/4) + 1 are used: two rows that link share one of them at least. The order puts shingles that stand in many documents last (by a
sketch of counts over all documents), so passages that many documents share drop out of the product; any order gives the same result.
The product goes by columns: the entries of a shingle meet in one sorted run, shingles with a single class vanish.

1. Each column pairs its classes with its smallest one only (a star), which takes rows in proportion to entries. Overlap counts are added
   up per pair; pairs below the bound are discarded, the others are counted in full on the whole sets.
2. Classes that are now in one component need no further comparison, and columns within one component drop out. Some rounds of chains
   over the others, each in another order, join most of what belongs together, again with rows in proportion to entries.
3. For the columns that still hold several components, all pairs of different components and fitting sizes are added up, bounded and
   counted in full in the same way. Only entries outside a column's main component meet the others. Columns of more than LONG classes
   are multiplied out inside tasks, a block of BLOCK classes by another, and a pair leaves its task only if the parity signatures of the two
   sets allow a link. A signature has four bits a shingle, each the parity of how many shingles fall on it. Two sets differ in at least as
   many shingles as their signatures differ in bits (d), and they link only if they differ in (n + m) / 7 or fewer, so pairs with
   7 d > n + m cannot link. That is exact for all sizes; beyond MOST_BITS / 4 shingles, where signatures grow no more, it rules out less.
   Rounds before this step take, of each class outside the main component, only the pair in a block whose signatures differ least for
   their sizes. They join nearly all that links, with pairs in proportion to entries.

So every link between different components is found, and big groups of near copies never become all their pairs. The bound: pairs that share
c of their leading shingles share at most c + max(n - lead(n), m - lead(m)) in all. In the first two steps c is the number of columns where the
two happen to be paired, which may discard too much; the third step makes up for it.

Links inside a component that is joined already are not looked for: the result is components, not all links nor their number.

Null text or text without words: empty set, linked with nothing. Fewer than 5 words: the whole sequence is the one shingle. Null doc_id:
takes part, is never a component_id unless the whole component has none. Repeated rows: each is returned. Empty table: no rows.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetprep.cluster import small_batches, stage
from fleetprep.llm import scan
from fleetprep.llm.bitmaps import bitmap, within
from fleetprep.llm.components import components
from fleetprep.llm.tables import only, query, table

WIDTH = 5
SKETCH_BITS, CHUNK_BITS = 21, 12
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 14  # of a signature
LONG, BLOCK = 64, 4096  # columns beyond LONG classes are multiplied out in blocks of about BLOCK classes
TILE, TILE_BYTES = 1 << 16, 1 << 22  # pairs, and bytes of signatures, that a task looks at together


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted set of shingles of each text of a slice."""
    x = scan.read(column, True)
    h = x.word_hashes()
    grams, at = scan.windows(h, x.first, WIDTH)
    cut = np.searchsorted(at, x.first)
    out = []
    for a, b, lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), x.first[:-1].tolist(), x.first[1:].tolist()):
        if b > a:
            s = np.sort(grams[a:b])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif hi > lo:
            out.append(scan.windows(h[lo:hi], np.array([0, hi - lo]), hi - lo)[0])
        else:
            out.append(grams[:0])
    return out


def fingerprint(s: np.ndarray) -> int:
    """One number for a set of shingles, as a signed long."""
    total = scan.mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64, keepdims=True)
    return int(scan.mix(total + np.uint64(len(s))).view(np.int64)[0])


def signature(s: np.ndarray) -> bytes:
    """The parity of the number of shingles on each place; sets of similar size have equal lengths, or one twice the other."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (4 * len(s) - 1).bit_length()))
    at = scan.mix(s ^ np.uint64(0x3C3C3C3CC3C3C3C3)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def folded(sign: np.ndarray, words: int) -> np.ndarray:
    """Signatures as rows of 64-bit words, cut to fewer words: places that fall together add up their parities."""
    while sign.shape[1] > words:
        sign = sign[:, : sign.shape[1] // 2] ^ sign[:, sign.shape[1] // 2 :]
    return sign


def lead(n):
    """How many of a row's first shingles are needed."""
    return n - (3 * n + 3) // 4 + 1


def sets(batch):
    for lo, hi, column in scan.slices(batch.column("text")):
        yield lo, hi, shingle_sets(column)


def count_cells(counts: np.ndarray, shingles: np.ndarray) -> None:
    """Add shingles to the sketch; a cell stops at 255, which makes it a frequent one anyway."""
    cell, times = np.unique(shingles >> np.uint64(64 - SKETCH_BITS), return_counts=True)
    counts[cell] = np.minimum(counts[cell] + times, 255)


def classes(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: doc_id, n, cls of every document (chunk null), and counts of shingles by sketch cell (chunk, counts)."""
    cells = 1 << SKETCH_BITS

    def run(batches):
        counts, seen = np.zeros(cells, np.uint8), set()
        for batch in batches:
            for lo, hi, rows in sets(batch):
                keys = [fingerprint(s) for s in rows]
                fresh = [s for s, k in zip(rows, keys) if k not in seen and not seen.add(k)]
                if fresh:
                    count_cells(counts, np.concatenate(fresh))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, n), pa.array([len(s) for s in rows], pa.int64()), pa.array(keys, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    names=["doc_id", "n", "cls", "chunk", "counts"],
                )
                if len(seen) > 1 << 20:
                    seen.clear()
        if seen:
            parts = counts.reshape(-1, 1 << CHUNK_BITS)
            none = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.tobytes() for p in parts])], names=["doc_id", "n", "cls", "chunk", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, cls long, chunk int, counts binary")


def frequent_cells(sketch: DataFrame, shingles: int) -> np.ndarray:
    """Bits of the sketch cells that hold far more shingles than an even spread would give."""
    mean = shingles / (1 << SKETCH_BITS)
    limit = mean + 8 * mean**0.5 + 8

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.uint8).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([*total], pa.int32()), pa.array([np.packbits(t > limit).tobytes() for t in total.values()], pa.binary())], names=["chunk", "bits"])

    found = sketch.select("chunk", "counts").repartition("chunk").mapInArrow(run, "chunk int, bits binary").toArrow()
    out = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS), bool)
    for chunk, bits in zip(found.column("chunk").to_pylist(), found.column("bits").to_pylist()):
        out[chunk] = np.unpackbits(np.frombuffer(bits, np.uint8))
    return out.ravel()


def entries(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """h, cls, n: the leading shingles of every class; a class may come once from several tasks."""
    packed = np.packbits(frequent)

    def run(batches):
        often, seen = np.unpackbits(packed).astype(bool), set()
        for batch in batches:
            for _, _, rows in sets(batch):
                keys, kept, sizes = [], [], []
                for s in rows:
                    key = fingerprint(s)
                    if not len(s) or key in seen:
                        continue
                    seen.add(key)
                    k = lead(len(s))
                    late = often[s >> np.uint64(64 - SKETCH_BITS)]
                    first = s[~late][:k]
                    if len(first) < k:
                        first = np.concatenate((first, s[late][: k - len(first)]))
                    keys.append(key), kept.append(first), sizes.append(len(s))
                if len(seen) > 1 << 20:
                    seen.clear()
                if keys:
                    times = [len(x) for x in kept]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(kept).view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), times)), pa.array(np.repeat(np.array(sizes, np.int32), times))],
                        names=["h", "cls", "n"],
                    )

    return docs.select("text").mapInArrow(run, "h long, cls long, n int")


def columns(rows: DataFrame) -> DataFrame:
    """The entries of shingles that several classes share, each with the smallest class of its column (star, star_n)."""

    def out(*arrays):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["h", "cls", "n", "star", "star_n"])

    def run(batches):
        at = None  # the column that may go on: its shingle, first class and size, latest class, and whether it has several
        for batch in batches:
            h, cls, n = (batch.column(c).to_numpy() for c in ("h", "cls", "n"))
            if at and len(h) and h[0] == at[0]:
                same = int(np.searchsorted(h, at[0], "right"))
                new = np.flatnonzero(cls[:same] != np.concatenate(([at[3]], cls[: same - 1])))
                if len(new):
                    if not at[4]:
                        yield out(*[np.array([v], x.dtype) for v, x in zip((at[0], at[1], at[2], at[1], at[2]), (h, cls, n, cls, n))])
                    yield out(h[new], cls[new], n[new], np.full(len(new), at[1], cls.dtype), np.full(len(new), at[2], n.dtype))
                    at = (*at[:3], cls[same - 1], True)
                h, cls, n = h[same:], cls[same:], n[same:]
            if not len(h):
                continue
            new = np.concatenate(([True], h[1:] != h[:-1]))
            again = np.concatenate(([False], (h[1:] == h[:-1]) & (cls[1:] == cls[:-1])))  # a class that came from another task too
            begin = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            column = np.cumsum(new) - 1
            several = np.bincount(column[~again])[column] > 1
            keep = np.flatnonzero(several & ~again)
            if len(keep):
                yield out(h[keep], cls[keep], n[keep], cls[begin[keep]], n[begin[keep]])
            at = (h[-1], cls[begin[-1]], n[begin[-1]], cls[-1], bool(several[-1]))

    ordered = rows.repartition("h").sortWithinPartitions("h", "n", "cls")
    return ordered.mapInArrow(run, "h long, cls long, n int, star long, star_n int")


def bounded(pairs: DataFrame) -> DataFrame:
    """a, n, ra, b, m, rb, with one row per shared column -> the pairs whose overlap count leaves a chance to link."""
    counted = pairs.groupBy("a", "b").agg(*[F.first(c).alias(c) for c in ("n", "m", "ra", "rb")], F.count("*").alias("c"))
    behind = lambda n: F.expr(f"(3 * {n} + 3) div 4 - 1")
    return counted.where(F.col("c") + F.greatest(behind("n"), behind("m")) >= F.expr("(3 * (n + m) + 6) div 7"))


def stars(entry: DataFrame) -> DataFrame:
    """Each class of a column with the smallest one; root is the component of a class so far."""
    rows = entry.where("cls <> star AND 3 * n <= 4 * star_n")
    return rows.selectExpr("star AS a", "star_n AS n", "star AS ra", "cls AS b", "n AS m", "cls AS rb")


def open_entries(entry: DataFrame) -> DataFrame:
    """The entries of columns that hold several components; with the component that has most of them (main) and their number (k)."""
    roots = entry.groupBy("h", "root").agg(F.count("*").alias("n"))
    main = roots.groupBy("h").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("k"), F.count("*").alias("roots"))
    return entry.select("h", "cls", "n", "root").join(main.where("roots > 1").drop("roots"), "h")


def chains(entry: DataFrame, seed: int, part: int = 1000, steps: int = 2) -> DataFrame:
    """Each class of a column with the next ones in a random order that is the same in all columns; long columns are cut into parts."""
    order = F.xxhash64("cls", F.lit(seed))
    rows = entry.withColumn("o", order).withColumn("part", F.pmod("o", F.ceil(F.col("k") / part)))
    line = Window.partitionBy("h", "part").orderBy("o")
    me = F.struct("n", "cls", "root")
    rows = rows.withColumn("near", F.array(*[F.lag(me, i).over(line) for i in range(1, steps + 1)]))
    return sized(rows.select(me.alias("x"), F.explode("near").alias("y")).where("y IS NOT NULL AND x.root <> y.root"))


def sized(rows: DataFrame) -> DataFrame:
    """Pairs of structs x, y (n, cls, root) of fitting sizes, the smaller one first."""
    rows = rows.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("3 * y.n <= 4 * x.n")
    return rows.selectExpr("x.cls AS a", "x.n AS n", "x.root AS ra", "y.cls AS b", "y.n AS m", "y.root AS rb")


def crossings(entry: DataFrame) -> DataFrame:
    """All pairs of a column that are in different components; one of the two is not in the main one."""
    x, y = entry.where("root <> main").alias("x"), entry.alias("y")
    meet = F.expr("x.h = y.h AND x.root <> y.root AND (y.root = y.main OR x.n < y.n OR x.n = y.n AND x.cls < y.cls) AND 3 * y.n <= 4 * x.n AND 3 * x.n <= 4 * y.n")
    rows = x.join(y, meet)
    return sized(rows.select(F.struct("x.n", "x.cls", "x.root").alias("x"), F.struct("y.n", "y.cls", "y.root").alias("y")))


def differing(sign: dict[int, np.ndarray], place: np.ndarray, width: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many bits the signatures of each pair (i, j) differ; sign has the signatures by width, place where each row's stands."""
    out = np.zeros(len(i), np.int64)
    both = np.stack((width[i], width[j]))
    for w, v in np.unique(both, axis=1).T.tolist():
        these, least = np.flatnonzero((both[0] == w) & (both[1] == v)), min(w, v)
        step = max(1, TILE_BYTES // (8 * max(w, v)))
        for lo in range(0, len(these), step):
            k = these[lo : lo + step]
            x, y = folded(sign[w][place[i[k]]], least), folded(sign[v][place[j[k]]], least)
            out[k] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def product(group: pa.Table, nearest: bool = False) -> pa.Table:
    """The pairs of a block that are in different components and may link by their sizes and signatures; or, of each class outside
    the main component, only the pair whose signatures differ least for their sizes."""
    cls, n, root, main, left = (group.column(c).to_numpy() for c in ("cls", "n", "root", "main", "left"))
    texts = group.column("sign").to_pylist()
    width = np.array([len(t) // 8 for t in texts], np.int64)
    place, sign = np.zeros(len(cls), np.int64), {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        place[own] = np.arange(len(own))
        sign[w] = np.frombuffer(b"".join(texts[k] for k in own), np.uint64).reshape(-1, w)
    x, y = np.flatnonzero(left), np.flatnonzero(~left)
    found = [np.zeros((2, 0), np.int64)]
    step = max(1, TILE // max(1, len(y)))
    for lo in range(0, len(x), step):
        i, j = x[lo : lo + step, None], y[None, :]
        once = nearest | (root[j] == main[j]) | (n[i] < n[j]) | ((n[i] == n[j]) & (cls[i] < cls[j]))
        i, j = np.nonzero((root[i] != root[j]) & once & (3 * n[j] <= 4 * n[i]) & (3 * n[i] <= 4 * n[j]))
        i, j = x[lo + i], y[j]
        d, both = differing(sign, place, width, i, j), n[i].astype(np.int64) + n[j]
        near = np.flatnonzero(7 * d <= both)
        if nearest:
            near = near[np.lexsort((cls[j[near]], d[near] / both[near], i[near]))]
            near = near[np.flatnonzero(np.diff(i[near], prepend=-1))]
        found.append(np.stack((i[near], j[near])))
    i, j = np.concatenate(found, axis=1)
    turn = (n[j] < n[i]) | ((n[j] == n[i]) & (cls[j] < cls[i]))
    a, b = np.where(turn, j, i), np.where(turn, i, j)
    return pa.table({"a": cls[a], "n": n[a], "ra": root[a], "b": cls[b], "m": n[b], "rb": root[b]})


def signatures(docs: DataFrame, entry: DataFrame) -> DataFrame:
    """cls, sign of the classes of some entries."""
    wanted = stage(entry.select("cls").distinct())
    signs = whole_sets(docs, bitmap(wanted, "cls"), signature, "binary").withColumnRenamed("shingles", "sign")
    return stage(signs.join(wanted, "cls").dropDuplicates(["cls"]))


def products(entry: DataFrame, signs: DataFrame, nearest: bool = False) -> DataFrame:
    """As crossings, for long columns: blocks of classes are multiplied in tasks, and pairs that cannot link stay there."""
    parts = F.ceil(F.col("k") / BLOCK).cast("int")
    rows = entry.withColumn("part", F.pmod(F.xxhash64("cls"), parts).cast("int"))
    all_parts = F.sequence(F.lit(0), parts - 1)
    place = lambda i, j, left: F.struct(i.alias("i"), j.alias("j"), F.lit(left).alias("left"))
    as_x = F.when(F.col("root") != F.col("main"), F.transform(all_parts, lambda p: place(F.col("part"), p, True)))
    as_y = F.transform(all_parts, lambda p: place(p, F.col("part"), False))
    rows = rows.select("h", "cls", "n", "root", "main", F.inline(F.concat(F.coalesce(as_x, F.slice(as_y, 1, 0)), as_y)))

    def run(group: pa.Table) -> pa.Table:
        return product(group, nearest)

    return rows.join(signs, "cls").groupBy("h", "i", "j").applyInArrow(run, "a long, n int, ra long, b long, m int, rb long")


def whole_sets(docs: DataFrame, wanted: np.ndarray, form=None, kind: str = "array<long>") -> DataFrame:
    """cls, shingles of the classes in a bitmap (and some more); or form(shingles), which is of this kind."""

    def run(batches):
        seen = set()
        for batch in batches:
            for _, _, rows in sets(batch):
                keys, kept = [], []
                for s in rows:
                    key = fingerprint(s)
                    if key not in seen and within(wanted, np.array([key]).view(np.uint64))[0]:
                        seen.add(key)
                        keys.append(key), kept.append(s.view(np.int64))
                if len(seen) > 1 << 20:
                    seen.clear()
                if keys and form:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([form(s.view(np.uint64)) for s in kept])], names=["cls", "shingles"])
                elif keys:
                    off = np.concatenate(([0], np.cumsum([len(s) for s in kept]))).astype(np.int64)
                    lists = pa.LargeListArray.from_arrays(pa.array(off), pa.array(np.concatenate(kept))).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists], names=["cls", "shingles"])

    return docs.select("text").mapInArrow(run, f"cls long, shingles {kind}")


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, counted on whole sets."""
    wanted = bitmap(pairs.select(F.explode(F.array("a", "b")).alias("cls")), "cls")
    rows = whole_sets(docs, wanted).dropDuplicates(["cls"])
    both = pairs.join(rows.select(F.col("cls").alias("b"), F.col("shingles").alias("s")), "b").join(rows.select(F.col("cls").alias("a"), F.col("shingles").alias("t")), "a")
    return both.where(7 * F.size(F.array_intersect("s", "t")) >= 3 * (F.size("s") + F.size("t"))).select("a", "b", "ra", "rb")


def merged(entry: DataFrame, links: DataFrame) -> DataFrame:
    """The entries with the components that the links join."""
    roots = components(links.selectExpr("ra AS a", "rb AS b")).select(F.col("node").alias("root"), F.col("root").alias("joined"))
    return entry.join(roots, "root", "left").withColumn("root", F.coalesce("joined", "root")).drop("joined")


def similar(docs: DataFrame, rounds: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    small_batches(docs.sparkSession)
    rows = stage(classes(docs))
    members = rows.where("chunk IS NULL").select("doc_id", "n", "cls")
    shingles = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    entry = stage(columns(entries(docs, frequent_cells(rows.where("chunk IS NOT NULL"), shingles))))

    tried = stage(bounded(stars(entry)))
    found = stage(verified(docs, tried))
    links, pairs = found.select("a", "b"), tried.select("a", "b")
    entry = stage(open_entries(merged(entry.withColumn("root", F.col("cls")), found)))
    signs = None
    for k, step in enumerate(["chains"] * rounds + ["nearest"] * rounds + ["all"]):
        long = entry.where(F.col("k") > LONG)
        if step != "chains":
            some = not long.isEmpty()
            signs = signatures(docs, long) if some and signs is None else signs
        if step == "chains":
            tried = bounded(chains(entry, k))
        elif step == "nearest" and some:
            tried = products(long, signs, nearest=True).dropDuplicates(["a", "b"])
        elif step == "all":
            short = crossings(entry.where(F.col("k") <= LONG))
            tried = bounded(short.unionByName(products(long, signs)) if some else short)
        else:
            continue
        tried = stage(tried.join(pairs, ["a", "b"], "left_anti"))
        if tried.isEmpty():
            continue
        found = stage(verified(docs, tried))
        links, pairs = links.unionByName(found.select("a", "b")), pairs.unionByName(tried.select("a", "b"))
        if step != "all":
            entry = stage(open_entries(merged(entry, found)))
    roots = components(links)

    placed = members.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("doc_id", "n", F.coalesce("root", "cls").alias("root"))
    placed = stage(placed)
    first = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    both = placed.join(first, "root", "left")
    return both.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"))


@query("op1_ngram_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"))
