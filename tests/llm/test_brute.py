"""The operators that SQL cannot express, against brute force on small tables, and odd tables for them."""

import collections
import math
import random
import re
import zlib

import numpy as np
import odd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from conftest import SMALL

from fleetprep.llm import catalogue, components, decontamination, gru, lm_scoring, ngram_join, quality_classifier, sharding, token_files

RUN, _ = catalogue.registered()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# near duplicates


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def groups(rows):
    """(doc_id, set size, component) of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for k, (d, _) in enumerate(rows):
        ids[find(k)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return collections.Counter((d, len(sets[k]), least[find(k)] if sets[k] else d) for k, (d, _) in enumerate(rows))


def near_copies(seed=3):
    """Chains and families of edited copies, a passage that many share, and equal sets in other order."""
    r, rows = random.Random(seed), []
    passage = odd.prose(60, 77)
    for family in range(12):
        text = odd.prose(r.randint(5, 80), family).split()
        for _ in range(r.randint(1, 14)):
            for _ in range(r.randint(0, 3)):
                text[r.randrange(len(text))] = f"w{r.randrange(10**6)}"
            rows.append(" ".join(text))
    rows += [f"{odd.prose(r.randint(5, 90), 500 + k)} {passage}" for k in range(60)]
    rows += ["a b c d", "a b c d e", "A b\nc d", "a b c", "", None, "x", "x", "a b c d e f", "a b c d e f g h", "a b c d e f g"]
    return [(k, t) for k, t in enumerate(rows)]


def joined(df, rounds=2):
    return collections.Counter(tuple(r) for r in ngram_join.similar(df, rounds).select("doc_id", "n_shingles", "component_id").collect())


def test_ngram_join_equals_all_pairs(spark):
    rows = near_copies()
    df = odd.documents(spark, [(d, t, "en", "s", 0) for d, t in rows], more=True).repartition(5)
    assert joined(df) == groups(rows)


def test_ngram_join_is_the_same_in_any_order_of_shingles(spark, monkeypatch):
    """All cells frequent, none, or every other one."""
    rows = near_copies(4)
    df = odd.documents(spark, [(d, t, "en", "s", 0) for d, t in rows])
    for pattern in ([True], [False], [True, False]):
        cells = np.resize(np.array(pattern), 1 << ngram_join.SKETCH_BITS)
        monkeypatch.setattr(ngram_join, "frequent_cells", lambda *_, cells=cells: cells)
        assert joined(df) == groups(rows)


def test_ngram_join_on_given_documents(spark):
    docs = small(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert joined(docs) == groups(rows)


def test_ngram_join_odd_and_empty(spark):
    rows = [(r[0], r[1]) for r in odd.ROWS]
    assert joined(odd.documents(spark, more=True)) == groups(rows)
    assert joined(odd.documents(spark, [])) == {}


def test_ngram_join_long_columns_in_blocks(spark, monkeypatch):
    """Every open column goes through the block products, cut into blocks of a few classes; stars and chains find nothing, and
    the nearest pairs either join some or are left out."""
    rows = near_copies(5)
    monkeypatch.setattr(ngram_join, "LONG", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "stars", lambda entry, real=ngram_join.stars: real(entry).where("false"))
    monkeypatch.setattr(ngram_join, "chains", lambda entry, k, real=ngram_join.chains: real(entry, k).where("false"))
    df = odd.documents(spark, [(d, t, "en", "s", 0) for d, t in rows])
    assert joined(df) == groups(rows)
    assert joined(df, 0) == groups(rows)


def test_signatures_rule_out_no_link(monkeypatch):
    """A block against a plain version, in several tiles: each linking pair of different components once, and few others."""
    r = np.random.default_rng(9)
    monkeypatch.setattr(ngram_join, "TILE", 50)
    core = r.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = []
    for k in range(60):
        size = [40, 400, 3000][k % 3]
        keep = core[:size][r.random(size) < (0.99 if k % 2 else 0.85)]
        sets.append(np.unique(np.concatenate((keep, r.integers(0, 2**63, k % 7 * size // 40 + 1, dtype=np.uint64)))))
    cls, n = r.permutation(10**6)[:60], np.array([len(s) for s in sets], np.int32)
    root, main = np.where(np.arange(60) % 4 == 0, 7, cls), np.full(60, 7)
    signs = [ngram_join.signature(s) for s in sets]
    out = np.flatnonzero(root != main)
    both = np.concatenate((out, np.arange(60)))
    block = pa.table({"cls": cls[both], "n": n[both], "root": root[both], "main": main[both], "sign": [signs[k] for k in both], "left": np.arange(len(both)) < len(out)})
    got = collections.Counter((p["a"], p["b"]) for p in ngram_join.product(block).to_pylist())
    common = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(60) for j in range(i)}
    order = lambda i, j: tuple(int(cls[k]) for k in sorted((i, j), key=lambda k: (n[k], cls[k])))
    links = {order(i, j) for (i, j), c in common.items() if root[i] != root[j] and 7 * c >= 3 * (n[i] + n[j])}
    assert links and links <= set(got) and max(got.values()) == 1
    assert len(got) < 1.3 * len(links) + 5
    nearest = ngram_join.product(block, True).to_pylist()
    assert {(p["a"], p["b"]) for p in nearest} <= set(got) and len(nearest) <= len(out)
    assert {p[c] for p in nearest for c in "ab"} >= {int(cls[k]) for k in out} & {c for pair in links for c in pair}
    turned = [p for p in ngram_join.product(block).to_pylist() if (p["n"], p["a"]) > (p["m"], p["b"])]
    assert not turned


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(60)] + [(200, 100), (100, 150), (300, 300)] + [(500, 501 + k) for k in range(40)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 150: 100, 200: 100, **{k: 500 for k in range(500, 541)}}


def test_columns_hold_over_batches(spark):
    """Columns that go on over many Arrow batches, with classes that come from several tasks."""
    r = random.Random(5)
    rows = [(r.randrange(40) if k % 3 else 7, c, c % 50 + 1) for k in range(3000) for c in [r.randrange(300)]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = ngram_join.columns(spark.createDataFrame(rows, "h long, cls long, n int")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = collections.defaultdict(set)
    for h, c, n in rows:
        by[h].add((n, c))
    want = collections.Counter((h, c, n, min(v)[1], min(v)[0]) for h, v in by.items() if len(v) > 1 for n, c in v)
    assert collections.Counter(tuple(x) for x in got) == want


# sharding


def test_table_is_filled_in_turns():
    names, slots = ["a", "b", "c"], 13
    taken = [None] * slots
    orders = {n: [(o + k * s) % slots for k in range(slots)] for n in names for o, s in [sharding.preference(n, slots)]}
    while None in taken:
        for k, n in enumerate(names):
            free = [s for s in orders[n] if taken[s] is None]
            if free:
                taken[free[0]] = k
    assert sharding.fill(["c", "a", "b"], slots) == taken
    counts = collections.Counter(sharding.fill(sharding.SHARDS))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_rows_move_when_a_shard_leaves():
    before, after = sharding.fill(sharding.SHARDS), sharding.fill(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(before, after) if a != len(sharding.SHARDS) - 1)
    assert moved < 0.1 * len(before)


def test_sharding_places_every_row(spark, folder):
    import hashlib

    rows = sharding.place(odd.documents(spark, more=True), "doc_id", ["x", "y"], 101).collect()
    table = sharding.fill(["x", "y"], 101)
    assert len(rows) == len(odd.ROWS)
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r["slot"], r["shard"]) == (slot, "xy"[table[slot]])
    sharding.write_shards(odd.documents(spark), "doc_id", f"{folder}/out", ["x", "y"], 101, files=2)
    assert spark.read.parquet(f"{folder}/out").count() == len(odd.ROWS)
    assert sharding.place(odd.documents(spark, []), "doc_id").collect() == []
    for shards, slots in ((["x"], 100), ([], 101), (["x", "x"], 101)):
        with pytest.raises(ValueError):
            sharding.fill(shards, slots)


# quality classifier


def test_classifier_on_held_out_rows(spark):
    sf = SMALL.replace("sf0.001", "sf0.01")
    rows = RUN["op4_quality_classifier"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = rows[rows["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in held["doc_id"]]).all()
    assert (held["predicted"] == held["quality"]).mean() > 0.9 and (rows["predicted"] == (rows["score"] >= 0.3)).all()


def test_held_out_labels_do_not_matter(spark):
    docs, labels = small(spark, "documents"), small(spark, "labels")
    flipped = labels.withColumn("quality", F.when(quality_classifier.held_out(labels["doc_id"]), 1 - labels["quality"]).otherwise(labels["quality"]))
    a, b = (sorted(quality_classifier.score(docs.repartition(3), x).collect()) for x in (labels, flipped))
    assert a == b


def test_flat_forest_equals_single_walks():
    r = np.random.default_rng(0)
    x = r.random((500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    f = quality_classifier.grow(x, y, trees=30, depth=3, least=5)
    slow = []
    for row in x:
        total = f.start
        for k in f.roots:
            while f.feature[k] >= 0:
                k = f.child[k] + (row[f.feature[k]] > f.threshold[k])
            total += f.value[k]
        slow.append(1 / (1 + math.exp(-total)))
    assert np.allclose(f.scores(x), slow) and ((f.scores(x) > 0.5) == y).mean() > 0.95


def test_classifier_odd_and_empty(spark):
    for labels in (odd.labels(spark), odd.labels(spark, [])):
        rows = quality_classifier.score(odd.documents(spark, more=True), labels).collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in odd.ROWS)
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows} == {0.5}
    assert quality_classifier.score(odd.documents(spark, []), odd.labels(spark)).collect() == []
    kept = quality_classifier.accepted(odd.documents(spark, more=True), odd.labels(spark, []))
    assert kept.columns == odd.documents(spark, more=True).columns and kept.count() == len(odd.ROWS)


# token files


def encoded(spark, df):
    return [tuple(r) for r in token_files.encoded(df, token_files.tokenizer_path()).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start", "n_tokens").collect()]


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_files.tokenizer_path())
    for df in (small(spark, "documents").repartition(3), odd.documents(spark, more=True)):
        rows = [(r["doc_id"], r["text"] or "") for r in df.collect()]
        ids = [np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for _, t in rows]
        got = encoded(spark, df)
        assert collections.Counter((g[0], g[2], g[3]) for g in got) == collections.Counter((d, len(i), zlib.crc32(i.tobytes())) for (d, _), i in zip(rows, ids))
        assert [g[1] for g in got] == list(np.cumsum([0, *[g[2] for g in got]])[:-1])
        assert [g[0] for g in got] == sorted((d for d, _ in rows), key=lambda d: -(2**63) if d is None else d)
    assert encoded(spark, odd.documents(spark, [])) == []


def test_pair_grammar_round_trip():
    r = np.random.default_rng(1)
    for sizes in ([1], [5, 0, 1, 400], [3000, 2000, 1], [50] * 40):
        sizes = np.array(sizes)
        ids = r.choice([3, 3, 3, 4, 5, 2, 49407], sizes.sum()).astype(np.uint16)
        codes, n_codes, rules = token_files.compress(ids, sizes, 49408)
        assert n_codes.sum() == len(codes) and (token_files.expand(codes, rules, 49408) == ids).all()
        row = {"base": 49408, "doc_ids": list(range(len(sizes))), "doc_tokens": sizes.astype("<i8").tobytes(), "doc_codes": np.cumsum([0, *n_codes]).astype("<i8").tobytes(),
               "rules": rules.astype("<u2").tobytes(), "lengths": token_files.expansion_lengths(rules, 49408).astype("<i8").tobytes(), "codes": codes.tobytes()}
        shard, at = token_files.Shard(row), np.cumsum([0, *sizes])
        for k in range(len(sizes)):
            own = ids[at[k] : at[k + 1]]
            assert (shard.ids_of(k) == own).all()
            for lo, hi in ((0, 1), (1, 3), (7, 300), (len(own) - 1, len(own) + 5), (4, 4)):
                assert shard.ids_of(k, max(lo, 0), hi).tolist() == own[max(lo, 0) : hi].tolist()
    assert len(codes) < 0.8 * len(ids) and len(rules)


# decontamination


def plain_alignment(item, text):
    best, row = 0, [0] * (len(text) + 1)
    for i in item:
        new = [0]
        for k, t in enumerate(text):
            new.append(max(0, row[k] + (2 if i == t else -1), row[k + 1] - 1, new[k] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment_equals_plain_version():
    r = random.Random(2)
    items = [[r.randrange(6) + 1 for _ in range(r.randint(1, 15))] for _ in range(80)]
    texts = [[r.randrange(6) + 1 for _ in range(r.randint(1, 30))] for _ in range(80)]
    best, last = decontamination.align([np.array(x) for x in items], [np.array(x) for x in texts])
    assert best.tolist() == [plain_alignment(i, t) for i, t in zip(items, texts)]
    assert all(plain_alignment(i, t[: k + 1]) == b for i, t, b, k in zip(items, texts, best, last))


def parts(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_decontamination_equals_brute_force(spark):
    docs, items = small(spark, "documents"), small(spark, "benchmark")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.contaminated(docs, items).collect()}
    bench = [(r["item_id"], parts(r["text"])) for r in items.collect()]
    want = {}
    for d in docs.collect():
        w = parts(d["text"])
        have = {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
        for item, own in bench:
            if any(tuple(own[k : k + 3]) in have for k in range(len(own) - 2)):
                score = plain_alignment(own, w) / (2 * len(own))
                if score >= 0.5:
                    want[d["doc_id"], item] = round(score, 6)
    assert got == want and want


def test_edited_copies_are_found_and_places_named(spark):
    r, item = random.Random(8), odd.prose(40, 50).split()
    edited = list(item)
    for k in r.sample(range(40), 8):
        edited[k] = f"zz{k}"
    shorter = [w for k, w in enumerate(item) if k % 9]
    rows = [
        (1, f"{odd.prose(500, 51)} {' '.join(item).upper()}! {odd.prose(50, 52)}"), (2, f"{odd.prose(9, 53)}\n{', '.join(edited)}"), (3, " ".join(shorter)),
        (4, odd.prose(3000, 54)), (5, " ".join(item[:10]) + " " + odd.prose(40, 55)), (6, None),
    ]
    docs = odd.documents(spark, [(d, t, "en", "s", 0) for d, t in rows], more=True)
    got = {r["doc_id"]: r for r in decontamination.contaminated(docs, odd.items(spark, [(7, " ".join(item))])).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1]["score"], got[1]["first_word"], got[1]["last_word"]) == (1.0, 500, 539)


def test_item_in_every_document(spark):
    """An item that is copied everywhere has no rare words, and is found everywhere."""
    item = odd.prose(30, 60)
    docs = odd.documents(spark, [(k, f"{odd.prose(20, 100 + k)} {item}", "en", "s", 0) for k in range(150)])
    assert decontamination.contaminated(docs, odd.items(spark, [(1, item)])).count() == 150


def test_decontamination_odd_and_empty(spark):
    rows = decontamination.contaminated(odd.documents(spark, more=True), odd.items(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(1, 1), (2, 1), (3, 1)} and len(rows) == 3
    assert decontamination.contaminated(odd.documents(spark, []), odd.items(spark)).collect() == []
    assert decontamination.contaminated(odd.documents(spark), odd.items(spark, [])).collect() == []


# language model


def base_scores(rows):
    counts, tokens = collections.Counter(), []
    for d, t in rows:
        w = [*words(t), None]
        tokens.append(w)
        if d is None or zlib.crc32(str(d).encode()) % 10:
            counts.update(w)
    total = sum(counts.values())
    whole = total + 0.1 * (len(counts) + 1)
    return [(d, len(w), sum(x in counts for x in w), total, sum(math.log10((counts.get(x, 0) + 0.1) / whole) for x in w)) for (d, _), w in zip(rows, tokens)]


@pytest.mark.parametrize("hot", [1 << 17, 50, 1])
def test_base_score(spark, hot):
    for df in (small(spark, "documents"), odd.documents(spark, more=True)):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        got = lm_scoring.score(df, hot).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        got, want = sorted(got, key=key), sorted(base_scores(rows), key=key)
        assert [tuple(g)[:4] for g in got] == [w[:4] for w in want]
        assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9)
        assert all(g[5] < 0 and math.isfinite(g[5]) for g in got)


def test_model_beats_base_on_held_out(spark):
    rows = RUN["op9_lm_scoring"](spark, SMALL.replace("sf0.001", "sf0.01")).toPandas()
    held = rows[rows["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def test_lm_without_training_rows_and_empty(spark):
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    rows = lm_scoring.score(odd.documents(spark, [(k, "a b", "en", "s", 0) for k in held])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == r["base_score"] == 0 for r in rows) and len(rows) == 3
    assert lm_scoring.score(odd.documents(spark, [])).collect() == []


def test_gradients():
    r = np.random.default_rng(0)
    end = gru.TOKENS - 1
    texts = [np.append(r.integers(0, end, r.integers(1, 12)), end).astype(np.int32) for _ in range(6)]
    flat = gru.initial(r.random(gru.TOKENS) * 100).astype(np.float64)
    target, before, text = gru.laid_out(texts, end)
    p, g = gru.unpack(flat), np.zeros(gru.SIZE)
    hidden, saved = gru.forward(p, np.zeros((target.shape[1], gru.HIDDEN), np.float32), before, end)
    rows = np.flatnonzero(text.ravel() >= 0)
    _, back = gru.outputs(p, hidden.reshape(-1, gru.HIDDEN)[rows].astype(np.float64), target.ravel()[rows], gru.unpack(g))
    d_out = np.zeros((target.size, gru.HIDDEN))
    d_out[rows] = back
    gru.backward(p, saved, before, d_out.reshape(hidden.shape), gru.unpack(g))
    loss = lambda f: -gru.score(f, texts, end).sum() * math.log(10)
    for k in [*r.choice(np.flatnonzero(np.abs(g) > 1e-3), 12)]:
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-2
        down[k] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g[k]) < 0.02 * abs(g[k]) + 2e-3


def test_probabilities_add_up_and_state_is_carried():
    flat = gru.initial(np.ones(gru.TOKENS), 3) * 3
    end, first = gru.TOKENS - 1, [5, 390, 17]
    total = 0.0
    for t in range(gru.TOKENS):  # all continuations of one beginning
        total += 10 ** (gru.score(flat, [np.array([*first, t], np.int32)], end)[0] - gru.score(flat, [np.array(first, np.int32)], end)[0])
    assert abs(total - 1) < 1e-3
    texts = [np.append(np.random.default_rng(k).integers(0, end, 90), end).astype(np.int32) for k in range(7)]
    together, apart = gru.score(flat, texts, end), [gru.score(flat, [t], end, steps=7)[0] for t in texts]
    assert np.allclose(together, apart, rtol=1e-4)


def test_word_wise_encoding_equals_whole_texts():
    """Marks, digits, contractions, combining characters, special tokens, scripts and blanks in any order."""
    import pyarrow as pa

    from fleetprep.llm import scan

    encoder, r = token_files.Encoder(token_files.tokenizer_path()), random.Random(0)
    single = "abcXYZ'sdtm0129.,!?#-_é×÷ÀÉñßÿ̸́İΣςſﬁ½²٣漢 \n\t\x85\xa0 <|>Kµª`~@&*()[]{}"
    more = ["'s", "'re", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "å", "Å", "≠", "İ", "!'s", "x'd9", "12a3", "naïve,", "3.14", "a.b@c.com"]
    texts = ["".join(r.choice(single) if r.random() < 0.8 else r.choice(more) for _ in range(r.randint(0, 60))) for _ in range(4000)]
    for lo, hi, column in scan.slices(pa.array(texts), 2000):
        ids, sizes = encoder.encode(column)
        want = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts[lo:hi]]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_parts_of_long_items_and_short_items_are_found(spark):
    long, tail = odd.prose(128, 60), odd.prose(131, 61)
    items = odd.items(spark, [(1, long), (2, "zebra quilt mango"), (3, tail)])
    around = lambda text, k: f"{odd.prose(70, 62 + k)} {text} {odd.prose(70, 72 + k)}"
    texts = [around(" ".join(long.split()[20:60]), 0), around("Zebra, quilt mango!", 1), around(" ".join(tail.split()[-3:]), 2), around("zebra quilt of mango", 3)]
    docs = odd.documents(spark, [(k, t, "en", "s", 0) for k, t in enumerate(texts)])
    rows = sorted(tuple(r) for r in decontamination.contaminated(docs, items).collect())
    assert [(r[0], r[1], r[3], r[4]) for r in rows] == [(0, 1, 70, 109), (1, 2, 70, 72)]
    assert rows[0][2] < 0.5 and rows[1][2] == 1
