"""Hashed word shingles of whole batches of texts, in numpy, straight from Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pricewh.llm.common import ASCII_SPACE

MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (multiply and shift, in place)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0xD1B54A32D192ED03)
        return x ^ (x >> np.uint64(32))


# One random value for each byte (A-Z as a-z, white space 0), and odd factors for places and words.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in ASCII_SPACE]] = True
_BYTE[_SPACE] = 0
_BASE = 0xF1357AEA2E62A9C5


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, np.uint64)
    p[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(p)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column: hash (A-Z as a-z), row, and bytes by position; nulls have none."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data, self.n_rows = data, len(column)
        self.start = self.length = self.row = np.empty(0, np.int64)
        self.hash = np.empty(0, np.uint64)
        inside = ~_SPACE[data]
        if not inside.any():
            return
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]                  # a word never goes on in the next row
        opens[offsets[:-1][filled]] = inside[offsets[:-1][filled]]
        closes[offsets[1:][filled] - 1] = inside[offsets[1:][filled] - 1]
        self.start = np.flatnonzero(opens)
        self.length = np.flatnonzero(closes) + 1 - self.start
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        begin = self.start[0]
        stretch = np.diff(np.append(self.start, len(data)))
        place = np.arange(begin, len(data)) - np.repeat(self.start, stretch)
        with np.errstate(over="ignore"):
            value = _BYTE[data[begin:]] * _powers(int(stretch.max()))[place]
            self.hash = mix(np.add.reduceat(value, self.start - begin))

    def text(self, i: int) -> str:
        a = int(self.start[i])
        return self.data[a:a + int(self.length[i])].tobytes().lower().decode()


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the row it is in."""
    words = Words(column)
    return words.hash, words.row


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words of each row: (hashes, offsets of the rows in them).

    A row of fewer words has one shingle, the whole sequence; a row without words has none.
    """
    words, row = word_hashes(column)
    n_rows = len(column)
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])
    with np.errstate(over="ignore"):
        parts = [mix(words + np.uint64(k + 1) * np.uint64(_BASE)) for k in range(width)]
        n = max(len(words) - width + 1, 0)
        full = mix(sum((parts[k][k:k + n] for k in range(1, width)), parts[0][:n].copy())) if n else np.empty(0, np.uint64)
    out, sizes = [], np.zeros(n_rows, np.int64)
    for r in range(n_rows):
        if count[r] >= width:
            own = np.unique(full[first[r]:first[r + 1] - width + 1])
        elif count[r]:
            with np.errstate(over="ignore"):
                total = sum((parts[k][first[r] + k] for k in range(1, int(count[r]))), parts[0][first[r]])
                own = mix(np.array([total], np.uint64) ^ np.uint64(int(count[r])))
        else:
            continue
        out.append(own)
        sizes[r] = len(own)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 19):
    """Row slices of a batch with at most ``most`` bytes of text, or one row."""
    sizes = np.diff(np.frombuffer(batch.column(text).cast(pa.large_string()).buffers()[1], np.int64)
                    [batch.column(text).offset:batch.column(text).offset + batch.num_rows + 1])
    begin = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)
