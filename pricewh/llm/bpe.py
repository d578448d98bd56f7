"""Byte-pair encoding and decoding with a given word vocabulary (word ends marked ``</w>``).

Short words are merged on contiguous rank arrays, many words at once in numpy: a row holds the
parts of a word, another the rank of each adjacent pair; the smallest rank of each row is scanned
for, the boundary it names is deleted and the two neighbouring ranks are looked up anew, until no
pair has a rank.  Words of more than ``SHORT`` parts use the same order of merges over a heap and
linked parts, as scanning would take quadratic time there.

Texts are cut at white space; each piece is encoded once and remembered, as bytes of little-endian
unsigned 32-bit ids, so a document is one join of such pieces.  The table of pieces has two generations
of bounded size: when the younger is full, the older goes, but for pieces that were used since.

Which code points are letters and numbers is pinned to Unicode 16, the version that the vocabulary's
library cuts words by: Python's own tables are older and those of the ``regex`` package later.
"""

from __future__ import annotations

import gc
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import bound_batches, sha256_hex

SHORT = 64
#: Pieces in a generation of the table that a worker remembers (about 100 MB), besides those of the present batch.
REMEMBERED = 600_000
NO_RANK = 1 << 30

# White space by the Unicode property, and the word pattern of the vocabulary file.
_SPACE = r"\t-\r \x85\xa0  -     　"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_SPACES = regex.compile(rf"[{_SPACE}]+")
#: What often ends a word and is a word of its own behind letters.
_STOPS = frozenset(",.;:!?")
#: Python's ``split()`` also cuts at these four, which are no white space by the property.
_ONLY_PYTHON_SPACE = regex.compile(r"[\x1c-\x1f]")


# Letters and numbers that Unicode 16 added (first and last code points), and the lower-case
# letters of what has one since (first, last, first lower-case one).
UNICODE_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0),
    (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA)]
NEW_LOWER = [(0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
             (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
             (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB)]
_LOWER = {c: chr(low + c - a) for a, b, low in NEW_LOWER for c in range(a, b + 1)}
_NEW_LOWER = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in NEW_LOWER) + "]")


@lru_cache(maxsize=1)
def late_letters() -> frozenset[str]:
    """Letters and numbers of ``regex`` that came after Unicode 16."""
    known = {chr(c) for a, b in UNICODE_16 for c in range(a, b + 1)}
    later = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, range(0x80, 0x110000))))
    return frozenset(c for c in later if unicodedata.category(c) == "Cn" and c not in known)


def words_in(piece: str) -> list[str]:
    """Words of a piece by the pattern; letters of later Unicode versions count as other signs."""
    if piece.isascii() or late_letters().isdisjoint(piece):
        return _WORDS.findall(piece)
    plain = "".join("\ue000" if c in late_letters() else c for c in piece)
    return [piece[m.start():m.end()] for m in _WORDS.finditer(plain)]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte value in a byte-level vocabulary."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBPE:
    def __init__(self, path: str, remembered: int | None = None):
        self.remembered = remembered
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = np.array([(vocab[left], vocab[right]) for left, right in model["merges"]], np.int64)
        order = np.argsort(keys := pairs[:, 0] << 32 | pairs[:, 1])
        self.pairs, self.pair_rank = keys[order], order.astype(np.int32)    # sorted, for lookups in bulk
        self.merged = np.array([vocab[left + right] for left, right in model["merges"]], np.int32)  # by rank
        self.rank = dict(zip(keys.tolist(), range(len(keys))))
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [""] * size
        for s, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = s
        self.number = [str(i) for i in range(size)]
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # special tokens go by a key that no piece can be: pieces hold no white space
        self._fixed = {" " + t: np.uint32(i).tobytes() for t, i in self.special.items()}
        self._pieces, self._before = dict(self._fixed), {}

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        return np.frombuffer(self.encode_many([text])[0], "<u4")

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as bytes."""
        collects = gc.isenabled()
        gc.disable()                            # nothing here forms cycles, and tables are slow to look through
        try:
            return self._joined([self._cut(t) for t in texts])
        finally:
            if collects:
                gc.enable()

    def encode_lines(self, text: str) -> list[bytes]:
        """Ids of each line of a text; quicker than one text a line where lines are words."""
        whole, lines = text.split("\n"), self._lower(text).split("\n")
        odd = "<|" in text or _SPACES.search(text.replace("\n", "")) or _ONLY_PYTHON_SPACE.search(text)
        return self._joined([[low] if low and not (odd and ("<|" in line or _SPACES.search(low))) else self._cut(line)
                             for line, low in zip(whole, lines)])

    def _joined(self, cut: list[list[str]]) -> list[bytes]:
        if len(self._pieces) > (self.remembered or REMEMBERED):
            self._before, self._pieces = self._pieces, dict(self._fixed)
        known, before = self._pieces, self._before
        wanted = set().union(*cut).difference(known)
        known.update((p, before[p]) for p in wanted.intersection(before))
        self._learn(wanted.difference(before))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: np.ndarray) -> str:
        """Token strings with a space between: what a vocabulary file without a decoder asks for."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))

    def numbers(self, ids: np.ndarray) -> str:
        return " ".join(map(self.number.__getitem__, ids.tolist()))

    def _cut(self, text: str) -> list[str]:
        """Pieces between white space, lower-cased letter by letter, and special tokens."""
        if "<|" not in text:
            return self._cut_plain(text)
        cut = [[" " + s] if s in self.special else self._cut_plain(s) for s in self._special.split(text)]
        return [p for pieces in cut for p in pieces]

    @staticmethod
    def _lower(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")     # no final sigma
            if _NEW_LOWER.search(text):
                text = text.translate(_LOWER)
        return text.lower()

    def _cut_plain(self, text: str) -> list[str]:
        text = self._lower(text)
        if _ONLY_PYTHON_SPACE.search(text):
            return [p for p in _SPACES.split(text) if p]
        return text.split()

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces and remember them.  A word is a piece too."""
        known, words_of, words = self._pieces, {}, []
        for p in pieces:
            if p.isalpha():
                words.append(p)
            elif p[-1] in _STOPS and p[:-1].isalpha():
                words_of[p] = (p[:-1], p[-1])
            else:
                found = words_in(p)
                if len(found) == 1:
                    words.append(p)
                else:
                    words_of[p] = found
        new = {w for found in words_of.values() for w in found}.difference(known)
        new = [(w, w.encode()) for w in new.union(words)]
        for top in (4, 6, 8, 10, 12, 16, 24, SHORT):     # words of like length together: little padding
            now = [x for x in new if len(x[1]) <= top]
            new = [x for x in new if len(x[1]) > top]
            for i in range(0, len(now), 20_000):
                some = now[i:i + 20_000]
                known.update(zip((w for w, _ in some), self._merge_short([d for _, d in some])))
        for w, data in new:
            known[w] = np.array(self._merge_long(self._letters(data)), "<u4").tobytes()
        for p, found in words_of.items():
            known[p] = b"".join(map(known.__getitem__, found))

    def _letters(self, data: bytes) -> list[int]:
        return [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == keys, self.pair_rank[at], NO_RANK).astype(np.int32)

    def _merge_short(self, words: list[bytes]) -> list[bytes]:
        n = np.array([len(w) for w in words])
        width = int(n.max())
        column = np.arange(width)
        inside = column < n[:, None]
        ids = np.full((len(words), width), -1, np.int32)
        data = np.frombuffer(b"".join(words), np.uint8)
        ids[inside] = np.array(self.inner, np.int32)[data]
        ids[np.arange(len(words)), n - 1] = np.array(self.last, np.int32)[data[np.cumsum(n) - 1]]
        ranks = np.full((len(words), width), NO_RANK, np.int32)   # of the pair that begins in a column
        ranks[:, :-1][inside[:, 1:]] = self._ranks(ids[:, :-1][inside[:, 1:]], ids[:, 1:][inside[:, 1:]])
        done, place = np.full_like(ids, -1), np.arange(len(words))
        while len(place):
            i = ranks.argmin(axis=1)
            least = ranks[np.arange(len(place)), i]
            if (over := least == NO_RANK).any():
                done[place[over]] = ids[over]
                place, ids, ranks, i, least = (x[~over] for x in (place, ids, ranks, i, least))
            row = np.arange(len(place))
            ids[row, i] = self.merged[least]
            later = column[:-1] > i[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(later | (column[:-1] == i[:, None]), ranks[:, 1:], ranks[:, :-1])
            ids[:, -1], ranks[:, -1] = -1, NO_RANK
            for at in (i - 1, i):                                 # the pairs on both sides of the new part
                left, right = ids[row, np.maximum(at, 0)], ids[row, np.minimum(at + 1, width - 1)]
                pair = (at >= 0) & (at + 1 < width) & (right >= 0)
                ranks[row[pair], at[pair]] = self._ranks(left[pair], right[pair])
        kept = done >= 0
        joined = done[kept].astype("<u4").tobytes()
        ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return [joined[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_long(self, ids: list[int]) -> list[int]:
        look, n = self.rank.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [look(a << 32 | b, NO_RANK) for a, b in zip(ids, ids[1:])] + [NO_RANK]
        heap = [(r, i) for i, r in enumerate(pair) if r != NO_RANK]
        heapq.heapify(heap)

        def refresh(i: int) -> None:
            pair[i] = look(ids[i] << 32 | ids[after[i]], NO_RANK) if after[i] < n else NO_RANK
            if pair[i] != NO_RANK:
                heapq.heappush(heap, (pair[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if pair[i] != r:
                continue                        # merged away, or another pair by now
            gone = after[i]
            ids[i], pair[gone], after[i] = int(self.merged[r]), -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        return [x for x, r in zip(ids, pair) if r != -1]


@lru_cache(maxsize=2)
def codec(path: str, remembered: int | None = None) -> WordBPE:
    """One codec a worker process.  ``path`` must be readable on every executor."""
    return WordBPE(path, remembered)


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordBPE:
    """A codec for callers that remember the ids of words themselves: it keeps few pieces."""
    return WordBPE(path, 50_000)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>).  A null or empty text has no ids.  Every row is encoded on its own,
    repeated rows too; an empty table gives no rows; further columns are not read."""
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            ids = [np.frombuffer(x, "<i4") for x in bpe.encode_many([t or "" for t in b.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])

    picked = _picked(docs, id_col, text_col)
    return picked.mapInArrow(encode, f"doc_id {_kind(picked)}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids are an empty text."""
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            texts = [bpe.decode(np.array(ids or [], np.int64)) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    bound_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {_kind(encoded)}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids of each text and of the text decoded from these ids."""
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            n, of_ids, of_text = [], [], []
            for data in bpe.encode_many([t or "" for t in b.column("text").to_pylist()]):
                ids = np.frombuffer(data, "<u4")
                n.append(len(ids))
                of_ids.append(sha256_hex(bpe.numbers(ids)))
                of_text.append(sha256_hex(bpe.decode(ids)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                                              pa.array(of_text, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = _picked(docs, id_col, text_col)
    return picked.mapInArrow(digest, f"doc_id {_kind(picked)}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()
