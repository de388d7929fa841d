"""SentencePiece encoding and decoding for models of the merge (BPE) type, exactly as the library does it.

The library merges the adjacent pair whose union has the best score, leftmost first, until no union is a piece. The result is the only
sequence of pieces in which every two neighbours are compatible: merging their joined text again gives these two. It is found without
merging the whole text. An Aho-Corasick automaton over reversed pieces tells the longest piece that starts at each character; pieces
are tried from the longest to its shorter prefixes, the first that is compatible with the piece before it is taken, and where none is, the
place is marked as failed and the piece before it is taken back. A character that is no piece becomes one piece
per byte.

Normalisation is the library's. A text is cut into words where no piece goes over the cut, which is proved from the pieces when a model is
read; such words do not affect each other. What is known of short words is remembered, up to MEMO words a process. Longer words are
encoded anew, in time and memory in proportion to their length.

Null text: as the empty text, no ids. Texts of any length are one row of work each. Null or repeated doc_ids: every row is encoded and
returned. Empty table: no rows. Other columns are ignored. Models without byte pieces or of another type raise ValueError.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.llm import scan
from fleetprep.llm.tables import only, plus, query, table

MARK = "▁"  # fixed value: stands for a space
MEMO = 400_000  # words, and pairs of pieces, remembered by a process
MEMO_CHARS = 48  # longer words are not remembered
BYTE = re.compile(r"<0x([0-9A-F]{2})>")  # fixed value: how byte pieces are written
LETTER = "A-Za-z\u00c0-\u024f"  # Latin letters (and two signs among them)
LOW = rf"\x00-\x40\x5B-\x60\x7B-\x7F{MARK}"  # ASCII but for its letters, and the mark
#: ways to cut a text, finest first: around line feeds and between a letter and ASCII that is none; before marks
CUTS = [
    re.compile(rf"\n|[^{LETTER}\n]*[{LETTER}]+(?:[^{LETTER}{LOW}][^{LETTER}\n]*[{LETTER}]*)*|[^{LETTER}\n]+"),
    re.compile(rf"{MARK}+[^{MARK}]*|[^{MARK}]+"),
]


class Pieces:
    """A merge-type model: its pieces, their scores, and the automaton."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.text = [self.library.id_to_piece(k) for k in range(size)]
        special = [self.library.is_control(k) or self.library.is_unknown(k) or self.library.is_unused(k) for k in range(size)]
        bytes_at = {k: int(m[1], 16) for k in range(size) if self.library.is_byte(k) and (m := BYTE.fullmatch(self.text[k]))}
        if len(bytes_at) != 256:
            raise ValueError(f"{path}: only models with a piece for each byte are supported")
        self.byte_of = bytes_at
        self.id_of_byte = {b: k for k, b in bytes_at.items()}
        self.ids = {t: k for k, t in enumerate(self.text) if not special[k] and k not in bytes_at}
        self.score = {t: self.library.get_score(k) for t, k in self.ids.items()}
        self.silent = {k for k in range(size) if self.library.is_control(k)}
        self.unknown = {k for k in range(size) if self.library.is_unknown(k)}
        self.cut = next((cut for cut in CUTS if all(len(cut.findall(t)) == 1 for t in self.ids)), None)
        self.special = frozenset(bytes_at) | self.silent | self.unknown
        self.has_prefix = self.library.normalize("a").startswith(MARK)
        self.automaton = ahocorasick.Automaton()
        for t, k in self.ids.items():
            self.automaton.add_word(t[::-1], k)
        self.automaton.make_automaton()
        # by piece: its length, and the longest piece it starts with, itself left out (-1: none). Characters that are no piece follow
        # as numbers of their own, beyond the ids
        self.size = [len(t) for t in self.text]
        self.spare: dict[str, int] = {}
        self.shorter = [-1] * size
        for t, k in self.ids.items():
            if len(t) > 1:
                self.shorter[k] = next((self.ids[t[:n]] for n in range(len(t) - 1, 1, -1) if t[:n] in self.ids), None) or self.single(t[0])
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, tuple[str, int, str]] = {}
        self.digits = [str(k) for k in range(size)]
        self.spaced = [t.replace(MARK, " ") for t in self.text[:size]]
        self.n_ids = size
        probe = f"{MARK}the {MARK}{MARK} of 12 一\u0000 naïveté  in-between"
        if self.library.encode(probe) != self.encode(probe):
            raise ValueError(f"{path}: not a model of the merge type")

    def merge(self, text: str) -> list[str]:
        """Merge a short text step by step."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
            best = max((s for s in scores if s is not None), default=None)
            if best is None:
                break
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def single(self, char: str) -> int:
        """A character as a piece."""
        k = self.ids.get(char, self.spare.get(char))
        if k is None:
            k = self.spare[char] = len(self.text)
            self.text.append(char)
            self.size.append(1)
            self.shorter.append(-1)
        return k

    def compatible(self, a: int | None, b: int) -> bool:
        """Whether merging leaves two neighbours as they are, or the first piece of a text (a is None)."""
        left, right = "" if a is None else self.text[a], self.text[b]
        return self.merge(left + right) == ([left, right] if left else [right])

    def longest(self, text: str) -> dict[int, int]:
        """The longest piece that starts at each character, by the number of characters behind it."""
        found = list(self.automaton.iter(text[::-1]))  # longer ones come first at each place
        found.reverse()
        return dict(found)

    def split(self, text: str) -> list[int]:
        """The pieces of a normalised text."""
        longest, pairs, shorter, sizes = self.longest(text), self.pairs, self.shorter, self.size
        failed: set[int] = set()
        out: list[int] = []
        last, left = None, len(text)  # the piece before, and how many characters are still to go
        while left:
            piece = longest.get(left - 1)
            if piece is None:
                piece = self.single(text[-left])
            while True:
                rest = left - sizes[piece]
                if rest not in failed:
                    key = piece if last is None else (last + 1) << 21 | piece
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= MEMO:
                            pairs.clear()
                        fits = pairs[key] = self.compatible(last, piece)
                    if fits:
                        break
                piece = shorter[piece]
                while piece < 0:  # nothing goes on from here: take the last piece back
                    failed.add(left)
                    piece = out.pop()
                    left += sizes[piece]
                    last = out[-1] if out else None
                    piece = shorter[piece]
            out.append(piece)
            last, left = piece, rest
        return out

    def ids_of(self, pieces: list[int]) -> list[int]:
        if max(pieces, default=0) < self.n_ids:
            return pieces
        return [x for k in pieces for x in ((k,) if k < self.n_ids else [self.id_of_byte[b] for b in self.text[k].encode()])]

    def words(self, text: str) -> list[str]:
        """The parts of a text that are encoded apart from each other, normalised."""
        normal = self.library.normalize(text)
        return self.cut.findall(normal) if self.cut else [normal] if normal else []

    def encode(self, text: str) -> list[int]:
        return [k for word in self.words(text) for k in self.ids_of(self.split(word))]

    def decode(self, ids: Sequence[int]) -> str:
        """The text that ids stand for; bytes that are no UTF-8 become U+FFFD, and the mark that encoding puts in front goes."""
        if self.special.isdisjoint(ids):
            back = "".join([self.spaced[k] for k in ids])
            return back[1:] if self.has_prefix and ids and self.text[ids[0]].startswith(MARK) else back
        out, run, first = [], bytearray(), True
        for k in [*ids, None]:
            if k in self.byte_of:
                run.append(self.byte_of[k])
                first = False
                continue
            out.extend(characters(run))
            run.clear()
            if k is None or k in self.silent:
                continue
            piece = " ⁇ " if k in self.unknown else self.spaced[k]
            out.append(piece[1:] if first and self.has_prefix and self.text[k].startswith(MARK) else piece)
            first = False
        return "".join(out)

    def word(self, word: str) -> tuple[str, int, str]:
        """A word's ids as text, their number, and what they decode to within a text."""
        ids = self.ids_of(self.split(word))
        back = self.decode([self.ids[MARK], *ids])  # decoding takes the mark in front away
        found = (",".join([self.digits[k] for k in ids]), len(ids), back)
        if len(word) <= MEMO_CHARS:
            if len(self.known) >= MEMO:
                self.known.clear()
            self.known[word] = found
        return found

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids, sha256 of the text decoded from them."""
        if not (self.cut and self.has_prefix and MARK in self.ids):
            ids = self.encode(text)
            return len(ids), sha(",".join(map(str, ids))), sha(self.decode(ids))
        known = self.known.get
        found = [known(w) or self.word(w) for w in self.words(text)]
        back = "".join([f[2] for f in found])
        return sum([f[1] for f in found]), sha(",".join([f[0] for f in found])), sha(back[1:])


def characters(run: bytearray) -> str:
    """Bytes as text; each byte that starts no whole character becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode())
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                size = 1
            at += size
        return "".join(out)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@functools.lru_cache(1)
def pieces(path: str) -> Pieces:
    """The model, read once by each process."""
    return Pieces(path)


def encoded(docs: DataFrame, model: str, column: str = "text") -> DataFrame:
    """docs with `ids`; the column holds text."""

    def run(batches):
        p = pieces(model)
        for batch in batches:
            for lo, hi, texts in scan.slices(batch.column(column)):
                ids = pa.array([p.encode(t) for t in texts.to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in batch.columns] + [ids], names=[*batch.schema.names, "ids"])

    docs = docs.drop("ids")
    return docs.mapInArrow(run, plus(docs.schema, "ids array<int>"))


def decoded(df: DataFrame, model: str) -> DataFrame:
    """df with `text`, decoded from its column `ids`; null ids give the empty text."""

    def run(batches):
        p = pieces(model)
        for batch in batches:
            k = batch.schema.get_field_index("ids")
            back = pa.array([p.decode([x for x in ids or () if x is not None]) for ids in batch.column(k).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, back], names=[*batch.schema.names, "text"])

    df = df.drop("text")
    return df.mapInArrow(run, plus(df.schema, "text string"))


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""

    def run(batches):
        p = pieces(model)
        for batch in batches:
            for lo, hi, texts in scan.slices(batch.column("text")):
                found = [p.digest(t) for t in texts.to_pylist()]
                n, ids, back = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op12_piece_encoding")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(only(table(spark, sf_dir, "documents"), "doc_id", "text"), model_path())
