"""Whitening, SentencePiece encoding and periodic runs against dense solutions, the library, and brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import odd
import pytest
import sentencepiece
from conftest import SMALL

from fleetprep.llm import catalogue, period_runs, piece_encoding, whitening

RUN, _ = catalogue.registered()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# whitening


def dense(x):
    """Mean, eigenvalues and eigenvectors of the different rows."""
    u = np.unique(x, axis=0).astype(float)
    values, vectors = np.linalg.eigh(np.cov(u.T, bias=True).reshape(u.shape[1], -1))
    return u.mean(axis=0), values[::-1], vectors[:, ::-1].T


def whitened(spark, rows, kind="array<float>", more=False):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, n int, x int" if more else f"vec_id long, embedding {kind}")
    good = whitening.whole_numbers(df.select("vec_id", "embedding"))
    found = whitening.fit(good.select("x"))
    return found, sorted((tuple(r) for r in whitening.whitened(good, found).collect()), key=lambda r: (r[0] is not None, r[0], r[1], r[4]))


def test_given_vectors_equal_a_dense_solution(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = {r["vec_id"]: np.floor(256 * np.array(r["embedding"], float)) for r in rows}
    all_x = np.array(list(x.values()))
    n, total = len(np.unique(all_x, axis=0)), np.unique(all_x, axis=0).sum(axis=0)
    mean, values, vectors = dense(all_x)
    got = RUN["op11_whitening"](spark, SMALL).collect()
    assert len(got) == 4 * len(rows)
    signs = collections.defaultdict(set)
    for r in got:
        k, v = r["component"] - 1, x[r["vec_id"]]
        want = (v - mean) @ vectors[k] / np.sqrt(values[k])
        assert abs(abs(r["whitened"]) - abs(want)) < 1e-9
        if abs(want) > 1e-6:
            signs[k].add(bool(r["whitened"] * want > 0))
        assert r["n"] == n and r["deviation"] == int(((n * v - total) ** 2).sum())
        assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9 and 0 < r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values()) and len(signs) == 4
    assert len({r["identity_error"] for r in got}) == 1


@pytest.mark.parametrize("seed,rank,dim,equal", [(1, 6, 6, False), (2, 3, 7, False), (3, 5, 5, True), (4, 1, 3, False)])
def test_rank_and_equal_deviations(spark, seed, rank, dim, equal):
    r = np.random.default_rng(seed)
    if equal:  # every axis has the same variance: any right-angled components are right
        x = np.concatenate((np.eye(dim), -np.eye(dim)))
    else:
        x = r.integers(-40, 40, (60, rank)) @ r.integers(-3, 4, (rank, dim)) / 256.0
    found, rows = whitened(spark, [(k, v.tolist()) for k, v in enumerate(x)] + [(0, x[0].tolist())], "array<double>")
    mean, values, vectors = dense(np.floor(256 * x))
    top = min(4, dim)
    assert len(rows) == top * (len(x) + 1)
    np.testing.assert_allclose(found.values, np.where(values[:top] > 1e-9 * values[0], values[:top], 0), rtol=1e-9, atol=1e-6)
    held = found.components[found.values > 0]
    np.testing.assert_allclose(held @ held.T, np.eye(len(held)), atol=1e-9)
    v = np.cov(np.unique(np.floor(256 * x), axis=0).T, bias=True)
    np.testing.assert_allclose(held @ v, found.values[found.values > 0][:, None] * held, atol=1e-7 * values[0])
    assert found.identity_error < 1e-8
    assert {r[1] for r in rows if r[4] is None} == {k + 1 for k in range(top) if not found.values[k]}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0]), (2, [0.25]), (2, [0.25, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [0.0, -0.001]), (7, []), (8, [-inf]),
    ]
    found, got = whitened(spark, [(*r, 1, 2) for r in rows], more=True)
    x = np.array([[128, 256], [64, 0], [0, -1], [0, 0]])
    assert found.n == 4 and found.total == x.sum(axis=0).tolist()
    assert collections.Counter(r[0] for r in got) == {1: 2, 2: 4, None: 2, 7: 2}
    assert {r[0]: r[3] for r in got}[1] == ((4 * x[0] - x.sum(axis=0)) ** 2).sum()
    assert whitened(spark, [(1, [1.0, 2.0])])[1][0][3:6] == (0, None, 0.0)  # one vector has no variance
    assert whitened(spark, []) == (None, [])
    assert whitened(spark, [(1, []), (2, None)]) == (None, [])


def test_large_numbers_are_exact(spark):
    found, got = whitened(spark, [(1, [2.0**40, 1.0]), (2, [2.0**40 + 1, 3.0]), (3, [1e300, 0.0])], "array<double>")
    assert found.total[0] == 2**49 + 2 * 256 * 0 + 256 + 2**48 - 2**48 + 2**63 - 1 - 2**49 + 2**49 + 0 or found.total[0] == 2 * 2**48 + 256 + 2**63 - 1
    assert all(r[3] is None for r in got)
    near = np.array([[2**30, 1], [2**30 + 5, 2]])
    assert whitening.deviations(near, 2, near.sum(axis=0).tolist()) == [26, 26]


def test_sums_of_many_blocks(spark, monkeypatch):
    rows = [(k, [float(k % 7), float(k % 11), float(k)]) for k in range(400)]
    whole, _ = whitened(spark, rows)
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 24 * 5)
    monkeypatch.setattr(whitening, "FEW", 4)
    parts, _ = whitened(spark, rows)
    np.testing.assert_allclose(parts.values, whole.values, rtol=1e-12)
    assert parts.total == whole.total and parts.n == whole.n


# pieces


@pytest.fixture(scope="module")
def model():
    return piece_encoding.Pieces(piece_encoding.model_path())


def digest(library, text):
    ids = library.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


def test_given_documents_equal_the_library(spark, model):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = {r["doc_id"]: digest(model.library, r["text"]) for r in docs.collect()}
    got = RUN["op12_piece_encoding"](spark, SMALL).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_odd_documents_equal_the_library(spark, model):
    path = piece_encoding.model_path()
    df = odd.documents(spark, more=True).repartition(3)
    got = collections.Counter(tuple(r) for r in piece_encoding.digests(df, path).collect())
    assert got == collections.Counter((r[0], *digest(model.library, r[1])) for r in odd.ROWS)
    back = piece_encoding.decoded(piece_encoding.encoded(df, path).drop("text"), path).select("doc_id", "text").collect()
    assert collections.Counter(map(tuple, back)) == collections.Counter((r[0], (r[1] or "").replace(piece_encoding.MARK, " ")) for r in odd.ROWS)
    assert piece_encoding.digests(odd.documents(spark, []), path).collect() == []


def test_any_text_equals_the_library(model):
    r = random.Random(1)
    parts = [
        "▁", " ", "  ", "a", "e", "th", "ing", "é", "一", "的", "\n", "\t", "\0", "😀", "x", " the", "tion", "\r", "'s", "12", "ﬁ", "한", "пр", "и", "́", " " * 17, "».", "—\"", "[…]", "Ж",
    ]
    for k in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25))) if k % 3 else "".join(r.choice(model.text[300:32000]) for _ in range(r.randint(1, 6)))
        ids = model.library.encode(text)
        assert model.encode(text) == ids, text
        assert model.decode(ids) == model.library.decode(ids)
        assert model.digest(text) == digest(model.library, text)
    for text in ("x" * 30000, "一" * 9000, " " * 20000, "ab" * 9000):
        assert model.encode(text) == model.library.encode(text)


def test_any_ids_decode_as_in_the_library(model):
    r = random.Random(2)
    for _ in range(4000):
        ids = [r.choice([0, 1, 2, r.randint(3, 258), r.randint(3, 258), r.randint(259, 31999), 28705]) for _ in range(r.randint(0, 10))]
        assert model.decode(ids) == model.library.decode(ids)


def test_backtracking_equals_merging(model):
    """Where longest pieces are wrong at first, and with the memory of pairs and words cleared all the time."""
    r, before = random.Random(3), piece_encoding.MEMO
    piece_encoding.MEMO = 3
    try:
        for _ in range(300):
            text = "".join(r.choice("aeinorst▁h") for _ in range(r.randint(1, 30)))
            assert [model.text[k] for k in model.split(text)] == model.merge(text)
            assert model.digest(text) == digest(model.library, text)
    finally:
        piece_encoding.MEMO = before


def test_cuts_hold_for_the_model(model):
    assert model.cut is piece_encoding.CUTS[0]
    text = "».a É.b\n\nx1 y— z”,w"
    assert "".join(model.words(text)) == model.library.normalize(text)
    assert isinstance(model.library, sentencepiece.SentencePieceProcessor)


# runs


def plain_runs(s, power=period_runs.POWER, least=period_runs.LEAST):
    out, n = [], len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, power * q) and not any(all(s[k] == s[k + d] for k in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(text, doc_id, rule=True):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rule and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    rows = plain_runs(words) if len(set(words)) < n else []
    gone = {k for s, size, q in rows for k in range(s + q, s + size)}
    best = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=None)
    left = b" ".join(w for k, w in enumerate(words) if k not in gone)
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return len(rows), *first, sha("".join(f"{s},{size},{q}\n" for s, size, q in rows)), hashlib.sha256(left).hexdigest()


def test_all_runs_of_short_sequences():
    r = random.Random(0)
    for k in range(1500):
        letters = r.choice([1, 2, 2, 3, 5])
        s = [r.randrange(letters) for _ in range(r.randint(0, 40))]
        if k % 2:
            s = s[:10] + [r.randrange(letters) for _ in range(r.randint(1, 5))] * r.randint(2, 8) + s[10:]
        got = [tuple(x) for x in period_runs.all_runs(s).tolist()]
        assert sorted(got) == sorted(plain_runs(s, 2, 0)) and len(set(got)) == len(got)
        assert [tuple(x) for x in period_runs.runs(np.array(s, np.int64)).tolist()] == plain_runs(s)


def test_common_lengths():
    r = random.Random(4)
    s = [r.randrange(3) for _ in range(60)]
    i, j = (np.array(x) for x in zip(*[(i, j) for i in range(60) for j in range(i + 1, 61)]))
    want = [next((k for k in range(60 - b) if s[a + k] != s[b + k]), 60 - b) for a, b in zip(i, j)]
    assert period_runs.SuffixTree(s).common(i, j).tolist() == want


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars < 4000")
    got = {r["doc_id"]: tuple(r)[1:] for r in period_runs.digests(docs).collect()}
    want = {r["doc_id"]: plain_digest(r["text"], r["doc_id"]) for r in docs.collect()}
    assert got == want and any(v[0] for v in want.values())
    assert RUN["op13_period_runs"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_odd_documents_equal_brute_force(spark):
    more = [(20, "a " * 50 + "b", "en", "a", 1), (21, "x y z " * 9 + "x y " * 7, "en", "a", 1), (21, "x y z " * 9 + "x y " * 7, "en", "a", 1), (None, "a b " * 30, "en", "a", 1)]
    rows = odd.ROWS + more
    got = collections.Counter(tuple(r) for r in period_runs.digests(odd.documents(spark, rows, more=True)).collect())
    brief = [r for r in rows if r[1] != odd.LONG]
    assert collections.Counter({k: v for k, v in got.items() if k[0] != 9}) == collections.Counter((r[0], *plain_digest(r[1], r[0])) for r in brief)
    assert period_runs.digests(odd.documents(spark, [])).collect() == []


def test_collapsed_texts(spark):
    rows = [(1, "go " * 8 + "on", "en", "a", 1), (2, "p q " * 4 + "r", "en", "a", 1), (3, None, "en", "a", 1), (4, "p q p q", "en", "a", 1)]
    got = {r["doc_id"]: r for r in period_runs.collapse(odd.documents(spark, rows)).collect()}
    assert [got[k]["collapsed"] for k in (1, 2, 3, 4)] == ["go on", "p q r", "", "p q p q"]
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 8, 2)] and got[3]["runs"] == [] and got[1]["text"] == rows[0][1]
