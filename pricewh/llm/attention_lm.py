"""Language-model scores: a causal self-attention model over subword ids, in numpy.

Words are cut into subword ids.  Each id belongs to a class.  The probability of an id is that of
its class, given the ids before it, times that of the id in its class:

    p(id | before) = softmax(attention(before) + log p(class | class before))[class] * p(id | class, id before)

* ``p(class | class before)`` and ``p(id | class, id before)`` are counts over all training documents.
  For the latter the commonest ids stand for themselves and all others for their class (``GROUPS``
  groups); the counts are mixed with those of ``p(id | class)``.
* Classes are found from the neighbours of ids, counted over all training documents.
* The attention part (one head, causal mask, a hidden layer) adds what a longer context tells.  It is
  trained by gradient descent on all windows of all training documents: each id of theirs is predicted at
  least once.  Windows are dealt to workers, whose number grows with the input; after each round the
  workers' weights, of a size that the ids bound, are averaged.

A document is scored in windows of ``WINDOW`` ids that overlap by ``CONTEXT``; each id is scored once,
in the first window that holds it.  All windows of a group of documents go through the model in batches.

Every text is cut and encoded once: a stored table of chunks of rows holds their ids and their words by number.
A chunk is a slice of what one task reads, bounded in bytes, so neither equal ids nor long texts meet in one.

Word counts for the unigram base: chunks send their different words, packed, to buckets by hash; a bucket
adds up the counts and answers each chunk with the counts of its words.  So no task holds the vocabulary of
the corpus, and a word that all documents use is one entry a chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewh.llm.bpe import WordBPE, codec, word_codec
from pricewh.llm.common import bound_batches, drop_stored, shuffles_dropped, stored
from pricewh.llm.shingles import Words, slices

#: Share of the windows of all training documents that attention is trained on: all, whatever their number.
SHARE = 1
#: Rounds of training, for one worker or many; after each the workers' weights are averaged.
ROUNDS = 5
#: Ids whose places before and behind an id tell its class.
NEIGHBOURS = 192
CLASSES, WIDTH, WINDOW, CONTEXT = 64, 32, 64, 16
STEPS, BATCH, RATE = 500, 160, 0.01
#: A worker takes as many windows as this many times STEPS take; least number of steps for one: STEPS.
#: Of a chunk the windows go to at most so many places (rounds of workers).
TIMES, PLACES = 4, 40
#: Windows of a batch that go through the layers together.
AT_ONCE = 40
#: Rows of weights that are changed together.
ROWS_AT_ONCE = 512
#: Groups of ids before; they bound the table of counts to GROUPS * (number of ids) cells.
GROUPS = 512
#: Added to the counts of ids in a class and of classes after a class; weight of p(id | class) in the mixture.
MORE, MIXED = 0.5, 10.0
#: Bytes of text of a chunk (or one row), documents per bucket of word counts, windows that are scored together.
CHUNK, PER_BUCKET, TOGETHER = 1 << 20, 4096, 128
#: Compression of stored tables: ids are small numbers in wide places, which only an entropy coder makes small.
CODEC = "zstd"
#: Different words whose ids a worker remembers (about 40 bytes each).
REMEMBERED = 1_000_000


@dataclass
class Network:
    """``slot``: row of ``embed`` of an id (0: in no training document); ``cls``: class of an id; ``group``: group of
    an id before.  The rest are the counted parts; ``cells`` are sorted numbers group * ids + id."""

    slot: np.ndarray
    cls: np.ndarray
    group: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)
    prior: np.ndarray = None        # log p(class | class before)
    in_class: np.ndarray = None     # log p(id | class)
    cells: np.ndarray = None
    cell_log: np.ndarray = None     # log p(id | class, group before) of a cell
    mixed_log: np.ndarray = None    # what log p(id | class) loses in a cell that is not there, by group and class

    def log_in_class(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log p(id | class, id before)."""
        group = self.group[before]
        out = self.in_class[ids] + self.mixed_log[group, self.cls[ids]]
        if len(self.cells):
            key = group.astype(np.int64) * len(self.cls) + ids
            at = np.minimum(np.searchsorted(self.cells, key), len(self.cells) - 1)
            out = np.where(self.cells[at] == key, self.cell_log[at], out)
        return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 when divided by 7.  A null id is not one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of probabilities).

    Tokens of the base are words with A-Z lower-cased and one end; the model scores subword ids and an
    end.  A null or empty text is its end alone.  Each row is scored on its own, repeated rows too, and
    repeated training rows count each time.  Without training rows all counts are 0 and the model is
    uniform.  An empty table gives no rows; further columns are not read.
    """
    bound_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    with shuffles_dropped(docs.sparkSession):                   # each round of training shuffles windows anew
        rows = id_rows(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                                   held_out(id_col).alias("held_out")), path)
        size = rows.agg(F.sum(F.size("doc_ids")), F.sum(F.when(~F.col("held_out"), F.size("doc_ids")))).first()
        n_docs, n_train = int(size[0] or 0), int(size[1] or 0)

        train = rows.filter("NOT held_out").select("ids", "sizes")
        network, windows_of_workers, workers = classed_network(train, path)
        finish(network, *summed(train.mapInArrow(_cells(path, sc.broadcast(network)), _COUNTED)))
        if windows_of_workers is not None:
            train_in_rounds(network, windows_of_workers, workers)
            drop_stored(windows_of_workers)
        answers = stored(count_words(rows, 8 + n_docs // PER_BUCKET), "word-counts", CODEC)
        total = answers.agg(F.sum("distinct_words"), F.sum("tokens")).first()
        tokens = int(total[1] or 0) + n_train
        distinct = int(total[0] or 0) + (n_train > 0)

    kind = docs.schema[id_col].dataType.simpleString()
    scored = rows.select("chunk", "held_out", "doc_ids", "ids", "sizes", "numbers", "n_words").mapInArrow(
        _scores(sc.broadcast(network), path),
        f"chunk long, held_out boolean, doc_ids array<{kind}>, numbers binary, n_words binary, scores binary")
    counts = answers.filter("chunk IS NOT NULL").select("chunk", "bucket", "counts")
    schema = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    return scored.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(
        _with_base(tokens, distinct, n_train), schema)


# -- ids of texts ---------------------------------------------------------------

class WordIds:
    """Ids of words that a worker has met, by hash: sorted hashes, and where the ids of each lie in one array.

    When there are too many words, those go that were not met since the last time."""

    def __init__(self, bpe: WordBPE):
        self.bpe = bpe
        self.hash, self.met = np.empty(0, np.uint64), np.empty(0, bool)
        self.first = self.size = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def find(self, words: Words, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place in ``ids`` and number of ids of each hash (sorted); ``at``: a word that has it."""
        place = np.searchsorted(self.hash, hashes)
        known = np.zeros(len(hashes), bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == hashes[inside]
        if not known.all():
            if len(self.hash) + len(hashes) > REMEMBERED:
                self._forget()
                place = np.searchsorted(self.hash, hashes)
                known = np.isin(hashes, self.hash, assume_unique=True)
            new = ~known
            encoded = self.bpe.encode_lines(_lines(words, at[new]))
            size = np.array([len(x) // 4 for x in encoded], np.int64)
            first = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)])
            where = place[new]
            self.hash, self.met = np.insert(self.hash, where, hashes[new]), np.insert(self.met, where, True)
            self.first, self.size = np.insert(self.first, where, first), np.insert(self.size, where, size)
            place = np.searchsorted(self.hash, hashes)
        self.met[place] = True
        return self.first[place], self.size[place]

    def _forget(self) -> None:
        keep = self.met if 2 * self.met.sum() <= REMEMBERED else np.zeros(len(self.met), bool)
        first, self.size, self.hash = self.first[keep], self.size[keep], self.hash[keep]
        self.first = np.cumsum(self.size) - self.size
        self.ids = self.ids[_spread(first, self.size)]
        self.met = np.zeros(len(self.hash), bool)


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each stretch, one stretch behind the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _lines(words: Words, at: np.ndarray) -> str:
    """Texts of some words, one a line.  No word holds a line feed."""
    size = words.length[at] + 1
    data = words.data[np.minimum(_spread(words.start[at], size), len(words.data) - 1)]
    data[np.cumsum(size) - 1] = 10
    return data.tobytes()[:-1].decode()


#: Ids of words, for each codec of the worker.
_IDS_OF_WORDS: dict[int, WordIds] = {}


def _forget_words() -> None:
    """Let go of what encoding remembers: for tasks that begin when all texts are encoded."""
    _IDS_OF_WORDS.clear()
    word_codec.cache_clear()


class Stream:
    """Subword ids of the rows of a text column, each with a start and an end id, one behind the other."""

    def __init__(self, column: pa.Array, bpe: WordBPE):
        self.words = Words(column)
        start, end = bpe.special["<|startoftext|>"], bpe.special["<|endoftext|>"]
        self.hash, at, self.inverse = np.unique(self.words.hash, return_index=True, return_inverse=True)
        if id(bpe) not in _IDS_OF_WORDS:
            _IDS_OF_WORDS[id(bpe)] = WordIds(bpe)
        table = _IDS_OF_WORDS[id(bpe)]
        first, n_ids = table.find(self.words, self.hash, at)
        n = n_ids[self.inverse]
        total, n_rows = int(n.sum()), len(column)
        row = np.repeat(self.words.row, n)
        per_row = np.bincount(row, minlength=n_rows) + 2
        self.offset = np.concatenate([[0], np.cumsum(per_row)])
        self.ids = np.empty(self.offset[-1], np.int32)
        self.ids[np.arange(total) + 2 * row + 1] = table.ids[_spread(first[self.inverse], n)]
        self.ids[self.offset[:-1]], self.ids[self.offset[1:] - 1] = start, end


# -- training -------------------------------------------------------------------

#: A table of counts without cells.
_NOTHING = np.empty(0, np.int64), np.empty(0, np.int64)


def train_network(texts: list[str], path: str) -> Network:
    """The model of a few texts, trained in this process."""
    bpe = codec(path)
    stream = Stream(pa.array(texts, pa.string()), bpe)
    count = np.bincount(stream.ids, minlength=len(bpe.token))
    common = common_ids(count)
    network = network_of(count, *neighbour_counts(stream, common))
    if texts:
        finish(network, *cell_counts(network, stream))
        own = training_windows(stream)
        network.p, _ = descend(network, own, 0, max(STEPS, -(-len(own) // BATCH)), 7)
    return network


def id_rows(texts: DataFrame, path: str) -> DataFrame:
    """A stored table of chunks of rows (chunk, held_out, doc_ids, ids, sizes, words, numbers, n_words): the rows' ids
    and how many each has; hashes of their different words, sorted, each word as a number in them, and words a row.

    ``texts`` has text, and doc_id and held_out where the rows are scored later; a chunk is held out or not."""
    for name, value in (("doc_id", F.lit(None).cast("bigint")), ("held_out", F.lit(False))):
        texts = texts if name in texts.columns else texts.withColumn(name, value)

    def run(batches):
        bpe, n, task = word_codec(path), 0, TaskContext.get().partitionId()
        for b in batches:
            held = b.column("held_out").to_numpy(zero_copy_only=False)
            for flag in (False, True):
                for part in slices(b.filter(pa.array(held == flag)), "text", CHUNK):
                    s, doc_ids = Stream(part.column("text"), bpe), part.column("doc_id")
                    n_words = np.bincount(s.words.row, minlength=part.num_rows)
                    packed = [s.ids.astype(_kind(bpe)), np.diff(s.offset).astype(np.int64), s.hash,
                              s.inverse.astype(_numbers(len(s.hash))), n_words.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(task << 32) + n], pa.int64()), pa.array([flag]),
                         pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                         *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                        names=["chunk", "held_out", "doc_ids", "ids", "sizes", "words", "numbers", "n_words"])
                    n += 1

    kind = texts.schema["doc_id"].dataType.simpleString()
    return stored(texts.select("doc_id", "text", "held_out").mapInArrow(
        run, f"chunk long, held_out boolean, doc_ids array<{kind}>, ids binary, sizes binary, words binary, "
             "numbers binary, n_words binary"), "ids", CODEC)


def _numbers(different: int) -> type:
    return np.uint16 if different <= 1 << 16 else np.uint32


def _kind(bpe: WordBPE) -> type:
    return np.uint16 if len(bpe.token) <= 1 << 16 else np.int32


@dataclass
class Rows:
    """Subword ids of rows, like a ``Stream`` without its words."""

    ids: np.ndarray
    offset: np.ndarray


def classed_network(train: DataFrame, path: str) -> tuple[Network, DataFrame | None, int]:
    """An untrained model with the classes and groups of all training rows (``id_rows``); all of their windows,
    as a table (turn, worker, source, windows); number of workers."""
    n_ids = len(codec(path).token)
    train = train.select("ids", "sizes")
    ids, n = summed(train.mapInArrow(_id_counts(path), _COUNTED))
    count = np.zeros(n_ids + 1, np.int64)
    count[ids] = n
    count, n_windows = count[:-1], int(count[-1])
    if not n_windows:
        return network_of(count, *_NOTHING), None, 0
    workers = -(-n_windows // (TIMES * STEPS * BATCH))
    found = stored(train.mapInArrow(_neighbours_and_windows(path, common_ids(count), workers),
                                    f"{_COUNTED}, turn long, worker long, source long, windows binary"), "windows", CODEC)
    network = network_of(count, *summed(found.filter("part IS NOT NULL").select("part", "cells", "counts")))
    return network, found.filter("windows IS NOT NULL").select("turn", "worker", "source", "windows"), workers


def train_in_rounds(network: Network, windows_of_workers: DataFrame, workers: int) -> None:
    """Each round every worker goes on from the common weights with all of its windows of the round; then the weights
    are averaged."""
    sc = windows_of_workers.sparkSession.sparkContext
    steps = -(-STEPS // ROUNDS)
    for turn in range(ROUNDS):
        light = sc.broadcast(Network(network.slot, network.cls, network.group, network.p, network.prior))
        trained = (windows_of_workers.filter(F.col("turn") == turn).groupBy("worker")
                   .applyInArrow(_descend_worker(light, turn, steps),
                                 "part long, worker long, weights binary, mass binary"))
        parts = (trained.repartition("part").sortWithinPartitions("part", "worker")
                 .mapInArrow(_averaged, "part long, weights binary, mass binary").collect())
        flat, mass = _flat(network.p), np.zeros(_flat_rows(network.p), np.float64)
        for r in parts:
            own = np.arange(r.part, len(mass), PARTS)
            w = np.frombuffer(r.weights, np.float64).reshape(-1, WIDTH)
            m = np.frombuffer(r.mass, np.float64)
            known = m > 0                                       # rows that no worker trained stay
            flat[own[known]] = (w[known] / m[known][:, None]).astype(np.float32)
        network.p = _from_flat(flat, network.p)
        light.destroy()


#: Weights are averaged as rows of WIDTH numbers, in so many parts.
PARTS = 16


def _flat_rows(p: dict[str, np.ndarray]) -> int:
    return len(p["embed"]) + -(-sum(v.size for k, v in p.items() if k != "embed") // WIDTH)


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    """All weights as rows of WIDTH: first those of ids, then the others one behind the other."""
    out = np.zeros((_flat_rows(p), WIDTH), np.float32)
    out[:len(p["embed"])] = p["embed"]
    rest = np.concatenate([p[k].ravel() for k in sorted(p) if k != "embed"])
    out[len(p["embed"]):].reshape(-1)[:len(rest)] = rest
    return out


def _from_flat(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    n = len(like["embed"])
    p, rest, at = {"embed": flat[:n].copy()}, flat[n:].ravel(), 0
    for k in sorted(like):
        if k != "embed":
            p[k] = rest[at:at + like[k].size].reshape(like[k].shape).copy()
            at += like[k].size
    return p


def _descend_worker(network, turn: int, least: int):
    def run(key, table):
        model, worker = network.value, key[0].as_py()
        _forget_words()
        windows_of_rows = np.frombuffer(b"".join(table.sort_by("source").column("windows").to_pylist()),
                                        np.int32).reshape(-1, WINDOW + 1)
        steps = max(least, -(-len(windows_of_rows) // BATCH))   # no window of the round is left out
        p, seen = descend(model, windows_of_rows, turn * steps, steps, [7, worker, turn], ROUNDS * steps)
        flat = _flat(p)
        mass = np.ones(len(flat))                               # of a row of an id: how often it was met
        mass[:len(seen)] = seen
        out = [(k, worker, flat[k::PARTS].tobytes(), mass[k::PARTS].tobytes()) for k in range(PARTS)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                        names=["part", "worker", "weights", "mass"])
    return run


def _averaged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the weights and masses of a part over the workers."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for part, weights, mass in zip(*(b.column(c).to_pylist() for c in ("part", "weights", "mass"))):
            m = np.frombuffer(mass, np.float64)
            w = (np.frombuffer(weights, np.float32).reshape(-1, WIDTH) * m[:, None]).ravel()
            if part in sums:
                w, m = sums[part][0] + w, sums[part][1] + m
            sums[part] = w, m
    for part, (w, m) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([w.tobytes()], pa.binary()),
                                          pa.array([m.tobytes()], pa.binary())], names=["part", "weights", "mass"])


def descend(network: Network, own: np.ndarray, done: int, steps: int, seed, of: int | None = None
            ) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights after so many steps on the given windows (places behind a document's end are -1), and how often
    each row of ``embed`` was met.  ``done`` steps of ``of`` have gone before."""
    rng, of = np.random.default_rng(seed), of or steps
    p = {k: v.copy() for k, v in network.p.items()}
    now = Network(network.slot, network.cls, network.group, p, network.prior)
    moment = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    seen = np.zeros(len(p["embed"]))
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        while len(order) < BATCH:                               # every window once before one comes again
            order = np.concatenate([order, rng.permutation(len(own))])
        some, order = own[order[:BATCH]], order[BATCH:]
        real = some[:, 1:] >= 0
        some = np.maximum(some, 0)
        ids = some[:, :-1]
        seen += np.bincount(now.slot[ids[real]], minlength=len(seen))
        grads = _gradients(now, ids, now.cls[some[:, 1:]], real)
        rate = RATE * min(1.0, step / 20, (of + 1 - done - step) / (of / 2))
        for name, whole in grads.items():                       # in place: new arrays cost more than the sums
            for i in range(0, len(whole), ROWS_AT_ONCE):        # and so do arrays that leave the processor's cache
                g, m, s, w = (x[i:i + ROWS_AT_ONCE] for x in (whole, moment[name], square[name], p[name]))
                m *= 0.9
                m += g * np.float32(0.1)
                s *= 0.99
                g *= g
                s += np.multiply(g, 0.01, out=g)
                np.sqrt(np.multiply(s, 1 / (1 - 0.99 ** step), out=g), out=g)
                g += 1e-6
                np.divide(m, g, out=g)
                w -= np.multiply(g, rate / (1 - 0.9 ** step), out=g)
    return p, seen


def first_ids(stream: Stream | Rows) -> np.ndarray:
    """Where training windows begin: each id of a row but the first is behind one place of one window."""
    n = np.maximum(1, -(-(np.diff(stream.offset) - 1) // WINDOW))
    return np.repeat(stream.offset[:-1], n) + WINDOW * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def training_windows(stream: Stream | Rows) -> np.ndarray:
    """All windows: WINDOW ids and the id behind them, -1 behind the end of the row."""
    begins = first_ids(stream)
    end = stream.offset[np.searchsorted(stream.offset, begins, side="right")]
    at = begins[:, None] + np.arange(WINDOW + 1)
    return np.where(at < end[:, None], stream.ids[np.minimum(at, len(stream.ids) - 1)], -1).astype(np.int32)


def _streams(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[Rows]:
    kind = _kind(codec(path))
    for b in batches:
        for ids, sizes in zip(b.column("ids").to_pylist(), b.column("sizes").to_pylist()):
            yield Rows(np.frombuffer(ids, kind).astype(np.int32),
                       np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))]))


_COUNTED = "part long, cells binary, counts binary"
_FOUND = pa.schema([("part", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary()), ("turn", pa.int64()),
                    ("worker", pa.int64()), ("source", pa.int64()), ("windows", pa.binary())])


def _counted(cells: np.ndarray, n: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for k in range(PARTS):
        if (mine := cells % PARTS == k).any():
            row = {"part": k, "cells": cells[mine].tobytes(), "counts": n[mine].tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema)


def _id_counts(path: str):
    """How often each id occurs, and, behind the last id, the number of windows."""
    def run(batches):
        n_ids = len(codec(path).token)
        count = np.zeros(n_ids + 1, np.int64)
        for stream in _streams(batches, path):
            count[:-1] += np.bincount(stream.ids, minlength=n_ids)
            count[-1] += len(first_ids(stream))
        cells = np.flatnonzero(count)
        yield from _counted(cells, count[cells], pa.schema(list(_FOUND)[:3]))
    return run


def _neighbours_and_windows(path: str, common: np.ndarray, workers: int):
    def run(batches):
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng([7, task])
        tables = [_NOTHING]
        for i, stream in enumerate(_streams(batches, path)):
            tables.append(neighbour_counts(stream, common))
            if len(tables) == 16:
                tables = [added(tables)]
            own = training_windows(stream)
            place = rng.permutation(ROUNDS * workers)[:PLACES]
            place = place[rng.integers(0, len(place), len(own))]
            rows = [{"turn": int(k) // workers, "worker": int(k) % workers, "source": (task << 32) + i,
                     "windows": own[place == k].tobytes()} for k in np.unique(place)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _FOUND)
        yield from _counted(*added(tables), _FOUND)
    return run


def _cells(path: str, network):
    def run(batches):
        tables = [_NOTHING]
        for stream in _streams(batches, path):
            tables.append(cell_counts(network.value, stream))
            if len(tables) == 16:
                tables = [added(tables)]
        yield from _counted(*added(tables), pa.schema(list(_FOUND)[:3]))
    return run


def summed(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the tables of counts of all tasks."""
    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            for part, cells, n in zip(*(b.column(c).to_pylist() for c in ("part", "cells", "counts"))):
                own = held.setdefault(part, [])
                own.append((np.frombuffer(cells, np.int64), np.frombuffer(n, np.int64)))
                if len(own) == 16:
                    held[part] = [added(own)]
        for part, own in held.items():
            cells, n = added(own)
            yield pa.RecordBatch.from_pylist([{"part": part, "cells": cells.tobytes(), "counts": n.tobytes()}],
                                             pa.schema(list(_FOUND)[:3]))

    rows = counted.repartition("part").sortWithinPartitions("part").mapInArrow(run, _COUNTED).collect()
    return added([_NOTHING, *((np.frombuffer(r.cells, np.int64), np.frombuffer(r.counts, np.int64)) for r in rows)])


def network_of(count: np.ndarray, cells: np.ndarray, n: np.ndarray) -> Network:
    """A model at its start, from counts of ids and of their neighbours."""
    n_ids, rng = len(count), np.random.default_rng(7)
    seen = np.flatnonzero(count)
    if not len(seen):
        cls = (np.arange(n_ids) % CLASSES).astype(np.int32)
        return Network(np.zeros(n_ids, np.int32), cls, cls, _start_weights(rng, 1))
    slot = np.zeros(n_ids, np.int32)
    slot[seen] = np.arange(1, len(seen) + 1)
    cls = np.full(n_ids, CLASSES - 1, np.int32)
    cls[seen] = id_classes(count[seen], slot[cells // (2 * NEIGHBOURS)] - 1, cells % (2 * NEIGHBOURS), n, rng)
    group = cls.copy()
    most = np.argsort(-count[seen], kind="stable")[:GROUPS - CLASSES]
    group[seen[most]] = CLASSES + np.arange(len(most))
    return Network(slot, cls, group, _start_weights(rng, len(seen) + 1))


def _start_weights(rng: np.random.Generator, slots: int) -> dict[str, np.ndarray]:
    shape = {"embed": (slots, WIDTH), "place": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH),
             "v": (WIDTH, WIDTH), "own": (WIDTH, WIDTH), "seen": (WIDTH, WIDTH), "out": (WIDTH, CLASSES)}
    p = {name: (rng.standard_normal(s) * (0.3 if name in ("embed", "place") else s[0] ** -0.5)).astype(np.float32)
         for name, s in shape.items()}
    p["out"] *= 0.1
    return p | {"hidden": np.zeros(WIDTH, np.float32), "bias": np.zeros(CLASSES, np.float32)}


def common_ids(count: np.ndarray) -> np.ndarray:
    """The commonest ids."""
    return np.argsort(-count, kind="stable")[:NEIGHBOURS]


def neighbour_counts(stream: Stream | Rows, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells id * 2 * NEIGHBOURS + place of a common id behind it, or NEIGHBOURS + place of one before it."""
    place = np.full(max(int(common.max()), int(stream.ids.max(initial=0))) + 1, -1)
    place[common] = np.arange(len(common))
    inner = np.ones(len(stream.ids), bool)
    inner[stream.offset[1:] - 1] = False                        # no pair goes on in the next document
    left, right = stream.ids[:-1][inner[:-1]], stream.ids[1:][inner[:-1]]
    cells = []
    for side, (own, other) in enumerate(((left, right), (right, left))):
        known = place[other] >= 0
        cells.append(own[known].astype(np.int64) * (2 * NEIGHBOURS) + side * NEIGHBOURS + place[other[known]])
    return np.unique(np.concatenate(cells), return_counts=True)


def id_classes(count: np.ndarray, own: np.ndarray, column: np.ndarray, times: np.ndarray, rng: np.random.Generator
               ) -> np.ndarray:
    """Classes of ids by what stands before and behind them: k-means on shares of frequent neighbours."""
    n = len(count)
    table = np.zeros((n, 2 * NEIGHBOURS), np.float32)
    table[own, column] = times
    mean = (table.sum(axis=0, dtype=np.float64) / count.sum()).astype(np.float32)
    x = np.sqrt((table + 4 * mean) / (count[:, None] + 4).astype(np.float32))
    weight = np.sqrt(count)
    centres = x[rng.choice(n, min(CLASSES - 1, n), replace=False, p=weight / weight.sum())]
    for _ in range(12):
        near = ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        mass = np.bincount(near, weight, len(centres))
        for c in np.flatnonzero(mass):
            centres[c] = np.average(x[near == c], axis=0, weights=weight[near == c])
    return near.astype(np.int32)


class Room:
    """Arrays that are used again in the next batch: new ones of this size cost more than what is computed in them."""

    def __init__(self):
        self.held: dict[tuple, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, kind=np.float32) -> np.ndarray:
        size, key = math.prod(shape), (name, np.dtype(kind))
        if key not in self.held or len(self.held[key]) < size:
            self.held[key] = np.empty(size, kind)
        return self.held[key][:size].reshape(shape)


#: Room for the layers and their gradients.
_ROOM = Room()


def _gradients(network: Network, ids: np.ndarray, target: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean loss over real targets, added up over some windows at a time: they stay in the processor's cache."""
    p = network.p
    total = {k: np.zeros_like(v) for k, v in p.items()}
    share = (real / real.sum()).astype(np.float32)
    d_x = _ROOM("d_x", *ids.shape, WIDTH, kind=p["embed"].dtype)
    prepared = _joined_weights(network)
    for i in range(0, len(ids), AT_ONCE):
        some = slice(i, i + AT_ONCE)
        _add_gradients(total, d_x[some], network, prepared, ids[some], target[some], share[some])
    slot = network.slot[ids].ravel()
    met = np.zeros(len(p["embed"]), bool)
    met[slot] = True
    rows = np.flatnonzero(met)
    number = np.empty(len(met), np.int64)
    number[rows] = np.arange(len(rows))
    place = number[slot]
    columns = np.ascontiguousarray(d_x.reshape(-1, WIDTH).T)
    total["embed"][rows] = np.stack([np.bincount(place, c, len(rows)) for c in columns], axis=1)
    return total


def _joined_weights(network: Network) -> tuple[np.ndarray, ...]:
    """Weights q (scaled), k, v, own side by side, and turned; k and v, out and seen turned; what is added to logits by
    class before; whether exp(logits) can neither overflow nor be 0 in all classes."""
    p = network.p
    inner = np.concatenate([p["q"] * np.float32(WIDTH ** -0.5), p["k"], p["v"], p["own"]], axis=1)
    turned = np.ascontiguousarray(inner.T)
    # hidden values lie between -1 and 1, and the prior's largest between -log(CLASSES) and 0
    small = float((np.abs(p["out"]).sum(axis=0) + np.abs(p["bias"])).max()) < 75
    return (inner, turned, turned[WIDTH:3 * WIDTH], np.ascontiguousarray(p["out"].T), np.ascontiguousarray(p["seen"].T),
            network.prior + p["bias"], small)


def _over_windows(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sum of left.T @ right over the windows: many small products are quicker than a long one."""
    return (left.transpose(0, 2, 1) @ right).sum(axis=0)


#: Places that look back together, the later ones first: what lies ahead of all of them is not computed.
_SPANS = [(WINDOW // 2, WINDOW), (0, WINDOW // 2)]


def _add_gradients(total: dict[str, np.ndarray], d_x: np.ndarray, network: Network, prepared: tuple, ids: np.ndarray,
                   target: np.ndarray, share: np.ndarray) -> None:
    """Through the layers of ``_forward`` and backwards.  Weights of places looked at stay undivided by their sum:
    the narrow arrays beside them are divided instead."""
    p, (inner, turned, kv_turned, out_turned, seen_turned, added_to, small) = network.p, prepared
    n, t = ids.shape
    kind = inner.dtype
    room = lambda name, *shape: _ROOM(name, *shape, kind=kind)
    ones = np.ones(max(t, CLASSES), kind)
    x = np.take(p["embed"], network.slot[ids], axis=0, out=room("x", n, t, WIDTH), mode="clip")
    x += p["place"]
    joined = np.matmul(x, inner, out=room("inner", n, t, 4 * WIDTH))
    q, k, v, own = (joined[..., i * WIDTH:(i + 1) * WIDTH] for i in range(4))
    back = np.matmul(kv_turned, x.transpose(0, 2, 1), out=room("back", n, 2 * WIDTH, t))
    k_turned, v_turned = back[:, :WIDTH], back[:, WIDTH:]
    z, weight, looked = room("z", n, t, WIDTH), room("weight", n, t), []
    for lo, hi in _SPANS:
        a = np.matmul(q[:, lo:hi], k_turned[..., :hi], out=room(f"a{lo}", n, hi - lo, hi))
        np.clip(a, -40, 40, out=a)                              # then no maximum has to be taken out
        np.exp(a, out=a)
        a[..., lo:] *= _CAUSAL[lo:hi, lo:hi]
        np.divide(1, a @ ones[:hi], out=weight[:, lo:hi])
        np.matmul(a, v[:, :hi], out=z[:, lo:hi])
        looked.append(a)
    z *= weight[..., None]
    h = np.matmul(z, p["seen"], out=room("h", n, t, WIDTH))
    h += own
    h += p["hidden"]
    size = np.abs(h, out=room("size", n, t, WIDTH))
    size += 1
    h /= size                                                   # between -1 and 1
    logits = np.matmul(h, p["out"], out=room("out", n, t, CLASSES))
    logits += np.take(added_to, network.cls[ids], axis=0, out=room("prior", n, t, CLASSES), mode="clip")
    if not small:
        logits -= logits.max(axis=-1, keepdims=True)
    e = np.exp(logits, out=logits)
    mass = e @ ones[:CLASSES]
    e.reshape(-1)[np.arange(n * t) * CLASSES + target.ravel()] -= mass.ravel()
    factor = share / mass                                       # times e: gradient of the logits
    h *= factor[..., None]
    total["out"] += _over_windows(h, e)
    total["bias"] += factor.ravel() @ e.reshape(-1, CLASSES)
    d_joined = room("d_inner", n, t, 4 * WIDTH)
    d_q, d_k, d_v, d_h = (d_joined[..., i * WIDTH:(i + 1) * WIDTH] for i in range(4))
    size *= size
    np.divide(factor[..., None], size, out=size)
    np.multiply(np.matmul(e, out_turned, out=h), size, out=d_h)
    total["hidden"] += ones[:1].repeat(n * t) @ d_h.reshape(-1, WIDTH)
    total["seen"] += _over_windows(z, d_h)
    d_z = np.matmul(d_h, seen_turned, out=size)
    d_z *= weight[..., None]
    even = np.einsum("nti,nti->nt", d_z, z)                     # of d_a * a over the places looked at
    for (lo, hi), a in zip(_SPANS, looked):
        d_a = np.matmul(d_z[:, lo:hi], v_turned[..., :hi], out=room(f"d_a{lo}", n, hi - lo, hi))
        d_a -= even[:, lo:hi, None]
        d_a *= a
        np.matmul(d_a, k[:, :hi], out=d_q[:, lo:hi])
        for whole, left, right in ((d_k, d_a, q), (d_v, a, d_z)):
            if hi == t:
                np.matmul(left.transpose(0, 2, 1), right[:, lo:hi], out=whole)
            else:
                whole[:, :hi] += left.transpose(0, 2, 1) @ right[:, lo:hi]
    grown = _over_windows(x, d_joined)
    grown[:, :WIDTH] *= np.float32(WIDTH ** -0.5)
    for i, name in enumerate(("q", "k", "v", "own")):
        total[name] += grown[:, i * WIDTH:(i + 1) * WIDTH]
    np.matmul(d_joined, turned, out=d_x)
    total["place"] += d_x.sum(axis=0)


_CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_ONES = np.ones(max(WINDOW, CLASSES), np.float32)


def _forward(network: Network, ids: np.ndarray):
    p = network.p
    x = p["embed"][network.slot[ids]] + p["place"]
    q, k, v = x @ p["q"], x @ p["k"], x @ p["v"]
    s = q @ k.transpose(0, 2, 1)
    s *= np.float32(WIDTH ** -0.5)
    np.clip(s, -40, 40, out=s)                                  # then no maximum has to be taken out
    a = np.exp(s, out=s)
    a *= _CAUSAL
    a /= a.sum(axis=-1, keepdims=True)
    z = a @ v
    h = x @ p["own"] + z @ p["seen"] + p["hidden"]
    h = h / (1 + np.abs(h))                                     # between -1 and 1
    logits = h @ p["out"] + p["bias"] + network.prior[network.cls[ids]]
    return x, a, z, h, logits, (q, k, v)


# -- counts over the corpus -----------------------------------------------------

def cell_counts(network: Network, stream: Stream | Rows) -> tuple[np.ndarray, np.ndarray]:
    """Cells (group before * number of ids + id) of the rows, and how often each occurs."""
    use = np.ones(len(stream.ids), bool)
    use[stream.offset[1:] - 1] = False                          # nothing follows the end
    at = np.flatnonzero(use)
    return np.unique(network.group[stream.ids[at]].astype(np.int64) * len(network.cls) + stream.ids[at + 1],
                     return_counts=True)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of tables of counts."""
    cells, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return cells, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(cells)).astype(np.int64)


def finish(network: Network, cells: np.ndarray, n: np.ndarray) -> None:
    """Set the counted parts of the model."""
    n_ids = len(network.cls)
    group, ids = cells // n_ids, cells % n_ids
    total = np.bincount(ids, n, n_ids) + MORE
    network.in_class = np.log(total / np.bincount(network.cls, total, CLASSES)[network.cls])
    of_group = np.concatenate([np.arange(CLASSES), np.zeros(GROUPS - CLASSES, np.int64)])
    of_group[network.group] = network.cls                       # class of a group
    pairs = np.bincount(of_group[group] * CLASSES + network.cls[ids], n, CLASSES ** 2).reshape(CLASSES, CLASSES) + MORE
    network.prior = np.log(pairs / pairs.sum(axis=1, keepdims=True))
    network.prior[:, np.bincount(network.cls, minlength=CLASSES) == 0] = -1e4   # classes without ids
    network.prior -= np.log(np.exp(network.prior).sum(axis=1, keepdims=True))
    network.prior = network.prior.astype(np.float32)
    in_both = np.bincount(group * CLASSES + network.cls[ids], n, GROUPS * CLASSES).reshape(GROUPS, CLASSES) + MIXED
    network.mixed_log = math.log(MIXED) - np.log(in_both)
    network.cells = cells
    network.cell_log = np.log((n + MIXED * np.exp(network.in_class[ids])) / in_both[group, network.cls[ids]])


def count_words(rows: DataFrame, buckets: int) -> DataFrame:
    """Answers to chunks of ``id_rows`` (chunk, bucket, counts): how often the chunk's different words that fall into
    the bucket occur in training rows.  Of each bucket distinct_words and tokens, in a row without chunk.

    Buckets are ranges of hashes, so a chunk's answers in the order of buckets are in the order of its words."""
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, held, words, numbers in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                words = np.frombuffer(words, np.uint64)
                n = np.zeros(len(words), np.int64)
                if not held:
                    n = np.bincount(np.frombuffer(numbers, _numbers(len(words))), minlength=len(words))
                if len(words):
                    yield _by_bucket(chunk, words, n.astype(np.int64), buckets)

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for bucket, *rest in zip(*(b.column(c).to_pylist() for c in ("bucket", "chunk", "words", "counts"))):
                if bucket != now:
                    if held:
                        yield _answered(now, held)
                    now, held = bucket, []
                held.append(tuple(rest))
        if held:
            yield _answered(now, held)

    asked = rows.select("chunk", "held_out", "words", "numbers").mapInArrow(
        ask, "bucket long, chunk long, words binary, counts binary")
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        answer, "chunk long, bucket long, counts binary, distinct_words long, tokens long")


def _by_bucket(chunk: int, words: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = np.append(first[1:], len(bucket))
    cut = [(words[i:j].tobytes(), counts[i:j].tobytes()) for i, j in zip(first, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first], pa.int64()), pa.array([chunk] * len(cut), pa.int64()),
         pa.array([w for w, _ in cut], pa.binary()), pa.array([n for _, n in cut], pa.binary())],
        names=["bucket", "chunk", "words", "counts"])


def _answered(bucket: int, held: list[tuple]) -> pa.RecordBatch:
    names = ["chunk", "bucket", "counts", "distinct_words", "tokens"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    words = np.concatenate([np.frombuffer(w, np.uint64) for _, w, _ in held])
    counts = np.concatenate([np.frombuffer(n, np.int64) for _, _, n in held])
    _, inverse = np.unique(words, return_inverse=True)
    total = np.bincount(inverse, counts).astype(np.int64)
    mine = total[inverse]
    rows, at = [(None, bucket, None, int((total > 0).sum()), int(counts.sum()))], 0
    for chunk, w, _ in held:
        n = len(w) // 8
        rows.append((chunk, bucket, mine[at:at + n].tobytes(), 0, 0))
        at += n
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# -- scoring --------------------------------------------------------------------

def _scores(network, path: str):
    """Log10 probabilities of the rows of chunks, beside what the base is computed from."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget_words()
        layers = _prepared(network.value)
        names = ["chunk", "held_out", "doc_ids", "numbers", "n_words"]
        for b in batches:
            scores = [log10_scores(layers, stream).tobytes() for stream in _streams([b], path)]
            yield pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(scores, pa.binary())],
                                             names=[*names, "scores"])
    return run


def _with_base(tokens: int, distinct: int, n_train: int):
    """Rows of a chunk, with the base from the answers of the buckets."""
    def run(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        answers = counts.sort_by("bucket").column("counts").to_pylist()
        known = np.frombuffer(b"".join(answers), np.int64)
        n_words = np.frombuffer(chunk.column("n_words")[0].as_py(), np.int32).astype(np.int64)
        c = known[np.frombuffer(chunk.column("numbers")[0].as_py(), _numbers(len(known)))]
        n = len(n_words)
        row = np.repeat(np.arange(n), n_words)
        whole = math.log10(tokens + distinct + 1)
        base = np.bincount(row, np.log10(c + 1.0) - whole, n) + math.log10(n_train + 1) - whole
        n_known = np.bincount(row, c > 0, n).astype(np.int64) + (n_train > 0)
        held = chunk.column("held_out")[0].as_py()
        return pa.Table.from_arrays(
            [pc.list_flatten(chunk.column("doc_ids")), pa.array(np.full(n, held)), pa.array(n_words + 1),
             pa.array(n_known), pa.array(np.full(n, tokens, np.int64)), pa.array(base),
             pa.array(np.frombuffer(chunk.column("scores")[0].as_py(), np.float64))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def windows(offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First input and row of each window: a row's inputs are all its ids but the end."""
    stride = WINDOW - CONTEXT
    inputs = np.diff(offset) - 1
    n = 1 + np.maximum(0, -(-(inputs - WINDOW) // stride))
    row = np.repeat(np.arange(len(n)), n)
    return offset[:-1][row] + stride * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)), row


class Layers:
    """The model prepared for scoring: what depends on one id alone is looked up instead of computed."""

    def __init__(self, network: Network):
        p = self.p = network.p
        self.network = network
        inner = np.concatenate([p["q"] * np.float32(WIDTH ** -0.5), p["k"], p["v"], p["own"]], axis=1)
        self.of_id, self.of_place = p["embed"] @ inner, p["place"] @ inner
        self.of_place[:, 3 * WIDTH:] += p["hidden"]
        self.prior = network.prior + p["bias"]
        # log p(id | class, id before) by group and id seen in a cell
        n_ids = len(network.cls)
        seen = np.unique(network.cells % n_ids)
        self.column = np.full(n_ids, -1, np.int32)
        self.column[seen] = np.arange(len(seen))
        self.in_class = (network.in_class[seen] + network.mixed_log[:, network.cls[seen]]).astype(np.float32)
        self.in_class[network.cells // n_ids, self.column[network.cells % n_ids]] = network.cell_log
        # hidden values lie between -1 and 1: whether exp(logits) cannot overflow
        self.small = float(np.abs(p["out"]).sum(axis=0).max() + self.prior.max()) < 80
        # whether no product of a query and a key can reach 40
        longest = [sum(np.linalg.norm(part[:, i:i + WIDTH], axis=1).max() for part in (self.of_id, self.of_place))
                   for i in (0, WIDTH)]
        self.small_scores = float(longest[0] * longest[1]) < 40
        self._room = Room()

    def log_in_class(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """``Network.log_in_class`` by table."""
        if not self.in_class.size:
            return self.network.log_in_class(before, ids)
        column = self.column[ids]
        out = self.in_class[self.network.group[before], column]
        if (new := column < 0).any():
            out[new] = self.network.log_in_class(before[new], ids[new])
        return out

    def logits(self, ids: np.ndarray, first: int) -> np.ndarray:
        """Class logits behind each id of the windows from place ``first`` on.  They stand until the next call."""
        n, t = ids.shape
        m = t - first
        inner = np.take(self.of_id, self.network.slot[ids], axis=0, out=self._room("inner", n, t, 4 * WIDTH), mode="clip")
        inner += self.of_place[:t]
        q, k, v, own = (inner[..., i * WIDTH:(i + 1) * WIDTH] for i in range(4))
        a = np.matmul(q[:, first:], k.transpose(0, 2, 1), out=self._room("a", n, m, t))
        if not self.small_scores:
            np.minimum(a, 40, out=a)                            # then no maximum has to be taken out
        np.exp(a, out=a)
        a *= _CAUSAL[first:t, :t]
        z = np.matmul(a, v, out=self._room("z", n, m, WIDTH))
        z /= (a @ _ONES[:t])[..., None]
        h = np.matmul(z, self.p["seen"], out=self._room("h", n, m, WIDTH))
        h += own[:, first:]
        size = np.abs(h, out=z)
        size += 1
        h /= size
        out = np.matmul(h.reshape(-1, WIDTH), self.p["out"], out=self._room("out", n * m, CLASSES))
        out += np.take(self.prior, self.network.cls[ids[:, first:]].ravel(), axis=0,
                       out=self._room("prior", n * m, CLASSES), mode="clip")
        return out.reshape(n, m, CLASSES)


_LAYERS: list[tuple[Network, Layers]] = []


def _prepared(network: Network) -> Layers:
    """The layers of the worker's present model."""
    if not _LAYERS or _LAYERS[0][0] is not network:
        _LAYERS[:] = [(network, Layers(network))]
    return _LAYERS[0][1]


def log10_scores(layers: Layers | Network, stream: Stream | Rows) -> np.ndarray:
    """Log10 probability of each row's ids and end."""
    layers = layers if isinstance(layers, Layers) else Layers(layers)
    network = layers.network
    begin, row = windows(stream.offset)
    total = np.zeros(len(stream.offset) - 1)
    opens = begin == stream.offset[row]                         # windows that score their first ids too
    for some, first in ((np.flatnonzero(opens), 0), (np.flatnonzero(~opens), CONTEXT)):
        for i in range(0, len(some), TOGETHER):
            r = row[some[i:i + TOGETHER]]
            end = stream.offset[r + 1][:, None] - 1
            at = begin[some[i:i + TOGETHER]][:, None] + np.arange(WINDOW)
            scored = (at < end)[:, first:]
            at = np.minimum(at, end - 1)
            ids, target = stream.ids[at], stream.ids[at[:, first:] + 1]
            logits = layers.logits(ids, first)
            own = np.take_along_axis(logits, network.cls[target][..., None], -1)[..., 0]
            if not layers.small:
                top = logits.max(axis=-1)
                logits -= top[..., None]
                own -= top
            np.exp(logits, out=logits)
            log_p = own - np.log(logits @ _ONES[:CLASSES]) + layers.log_in_class(ids[:, first:], target)
            total += np.bincount(r, (log_p * scored).sum(axis=1, dtype=np.float64), len(total))
    return total / math.log(10)
