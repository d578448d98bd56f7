"""Packing documents into token windows, in their order, by dynamic programming.

The documents of a partition, each with an end token, form one stream.  Windows of at most ``size``
tokens cut it at document ends, sentence ends or, at a higher price, inside long sentences.  With
``f[j]`` the least cost of all windows up to cut ``j`` at token ``p[j]``,

    f[j] = WINDOW + price[j] + min over i of  f[i] + size - (p[j] - p[i]),   p[j] - p[i] <= size

where the padding ``size - (p[j] - p[i])`` falls away when a window's length is a power of two.  The
minimum of ``f[i] + p[i]`` over the sliding range of cuts comes from a monotone queue; the powers
of two are a few transitions more.  The stream is solved in chunks and the last windows of a chunk
are solved again with the next one, so memory holds a chunk or the longest document.

No shuffle: each scan partition is packed on its own, in row order, and leaves one partly filled
window at its end.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.bpe import WordBPE, codec
from pricewh.llm.common import bound_batches

SIZE, END_ID = 2048, 1
#: Costs in tokens of padding: of each window, of a cut at a sentence end, and inside a sentence.
WINDOW, AT_SENTENCE, IN_SENTENCE = 16, 8, 48
#: Stretches without a sentence end of more than LONG tokens may be cut every STEP tokens.
LONG, STEP = 128, 64
#: Shortest power of two that a window may have without padding.
LEAST_POWER = 128
#: Tokens that are solved together.
CHUNK = 1 << 20

PIECE = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         remembered: int | None = None) -> DataFrame:
    """One row for each piece of a document in a sequence: doc_id, start (tokens of the document
    before it), length, doc_tokens (with the end token), sequence_id, offset (in the sequence),
    ids (little-endian unsigned 32-bit).

    Each token lies in exactly one piece; pieces of a sequence follow each other without gaps.  A
    null or empty text is its end token alone.  Repeated rows are packed each.  An empty table gives
    no rows; further columns are not read.  ``remembered`` bounds the pieces that a worker's encoder
    keeps, where other work needs its memory.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, remembered)
        base = TaskContext.get().partitionId() << 36
        packer = Packer(sentence_ends(bpe), size)
        for b in batches:
            data = bpe.encode_many([t or "" for t in b.column("text").to_pylist()])
            packer.add(b.column("doc_id").to_pylist(), data)
            if packer.tokens >= CHUNK:
                yield _batch(packer.solve(base, last=False), b.column("doc_id").type)
            id_type = b.column("doc_id").type
        if packer.tokens:
            yield _batch(packer.solve(base, last=True), id_type)

    return picked.mapInArrow(run, f"doc_id {kind}, {PIECE}")


def sentence_ends(bpe: WordBPE) -> np.ndarray:
    """For each token id whether a sentence may end behind it."""
    return np.array([t.endswith("</w>") and t[:-4].rstrip("\"')]").endswith((".", "!", "?")) for t in bpe.token])


class Packer:
    """The stream of one partition that is not yet cut."""

    def __init__(self, ends: np.ndarray, size: int = SIZE):
        self.ends, self.size = ends, size
        self.docs: list[tuple] = []     # (doc_id, ids as bytes, tokens before them, tokens of the document)
        self.tokens = self.sequences = 0

    def add(self, doc_ids: list, encoded: list[bytes]) -> None:
        end = np.uint32(END_ID).tobytes()
        for doc_id, data in zip(doc_ids, encoded):
            n = len(data) // 4 + 1
            self.docs.append((doc_id, data + end, 0, n))
            self.tokens += n

    def solve(self, base: int, last: bool) -> list[tuple]:
        """Pieces of the windows that are final by now; all of them if ``last``."""
        places, prices = self._cuts()
        windows = cut_windows(places, prices, self.size)
        if not last:
            windows = [w for w in windows if w <= places[-1] - 4 * self.size] or windows
        rows, rest, begin, w = [], [], 0, 0     # begin: where the present window begins
        at = 0
        for doc_id, data, before, total in self.docs:
            n, done = len(data) // 4, 0
            while done < n and w < len(windows):
                take = min(n, windows[w] - at) - done
                rows.append((doc_id, before + done, take, total, base + self.sequences, at + done - begin,
                             data[4 * done:4 * (done + take)]))
                done += take
                if at + done == windows[w]:
                    begin, w, self.sequences = windows[w], w + 1, self.sequences + 1
            if done < n:
                rest.append((doc_id, data[4 * done:], before + done, total))
            at += n
        self.docs, self.tokens = rest, self.tokens - (windows[-1] if windows else 0)
        return rows

    def _cuts(self) -> tuple[list[int], list[int]]:
        """Tokens behind which the stream may be cut, and the price of each."""
        ids = np.frombuffer(b"".join(d[1] for d in self.docs), "<u4")
        price = np.full(len(ids) + 1, -1, np.int16)
        sentence = np.flatnonzero(self.ends[ids]) + 1
        price[sentence] = AT_SENTENCE
        price[0] = 0
        price[np.cumsum([len(d[1]) // 4 for d in self.docs])] = 0
        places = np.flatnonzero(price >= 0)
        gaps = np.diff(places)
        for k in np.flatnonzero(gaps > LONG):
            price[places[k] + STEP:places[k + 1]:STEP] = IN_SENTENCE
        places = np.flatnonzero(price >= 0)
        return places.tolist(), price[places].tolist()


def cut_windows(places: list[int], prices: list[int], size: int = SIZE) -> list[int]:
    """Ends of the cheapest windows.  ``places`` begins with 0 and has no gap above ``size``."""
    n, p = len(places), np.array(places)
    short: dict[int, list[int]] = {}
    k = LEAST_POWER
    while k < size:
        i = np.searchsorted(p, p - k)
        for j in np.flatnonzero(p[i] == p - k).tolist():
            short.setdefault(j, []).append(int(i[j]))
        k *= 2
    cost, origin = [0] * n, [0] * n
    queue: deque[int] = deque([0])              # cuts with rising cost + place: the first is the least
    keys = [0] * n
    for j in range(1, n):
        at = places[j]
        while places[queue[0]] < at - size:
            queue.popleft()
        i = queue[0]
        least = keys[i] + size - at
        for s in short.get(j, ()):
            if cost[s] < least:
                least, i = cost[s], s
        cost[j], origin[j] = least + prices[j] + WINDOW, i
        keys[j] = key = cost[j] + at
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    windows, j = [], n - 1
    while j > 0:
        windows.append(places[j])
        j = origin[j]
    return windows[::-1]


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    columns = list(zip(*rows)) or [()] * 7
    kinds = [id_type, *[pa.int64()] * 5, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
