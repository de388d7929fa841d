"""Words, hashes and windows against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetprep.llm import scan

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\t\x0b\x1cé ñ漢\x00.", max_size=80)), max_size=12)


def words(text, lower=False):
    raw = (text or "").encode()
    return re.findall(rb"[^\x20\x09-\x0D]+", raw.lower() if lower else raw)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_windows(texts, limit):
    found, grams = [], []
    for lo, hi, column in scan.slices(pa.array(texts, pa.string()), limit):
        x = scan.read(column, True)
        assert [len(words(t)) for t in texts[lo:hi]] == list(x.sizes)
        found += [bytes(x.buf[a:b]) for a, b in zip(x.start, x.end)]
        h = x.word_hashes()
        w, at = scan.windows(h, x.first, 3)
        owner = x.owner()
        grams += [(lo + int(owner[i]), tuple(bytes(x.buf[x.start[j] : x.end[j]]) for j in range(i, i + 3)), int(g)) for i, g in zip(at, w)]
    assert found == [w for t in texts for w in words(t, True)]
    want = [(k, tuple(ws[i : i + 3])) for k, t in enumerate(texts) for ws in [words(t, True)] for i in range(len(ws) - 2)]
    assert [g[:2] for g in grams] == want
    assert len({g[1] for g in grams}) == len({g[2] for g in grams}) == len({(g[1], g[2]) for g in grams})


def test_long_words_differ():
    texts = ["x" * n + c for n in (7, 8, 9, 63, 64, 65, 3000) for c in "ab"]
    x = scan.read(next(scan.slices(pa.array(texts)))[2])
    assert len(set(x.word_hashes().tolist())) == len(texts)
    again = scan.read(next(scan.slices(pa.array(["pad " + texts[-1]])))[2])
    assert again.word_hashes()[1] == x.word_hashes()[-1]


def test_sums():
    assert scan.sums(np.array([1, 2, 3]), np.array([0, 0, 2, 3, 3])).tolist() == [0, 3, 3, 0]


def test_windows_of_moved_words_differ():
    """All arrangements of two words; factors in proportion to the place gave those with equal sums of places one hash."""
    texts = [" ".join("xy"[n >> k & 1] for k in range(10)) for n in range(1 << 10)]
    x = scan.read(next(scan.slices(pa.array(texts)))[2])
    assert len(set(scan.windows(x.word_hashes(), x.first, 10)[0])) == len(texts)
