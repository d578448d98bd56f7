"""Ranked lexical search turned round: the index is over the queries, and the documents stream past it.

The items' terms form an inverted index (term -> items).  Each document's term counts go through it
once: a term's contribution depends on the document only, so it is added to every item in the term's
postings, and an item takes the document into its heap of the best ``top`` if it is good enough.
Tasks return their heaps, at most ``top`` rows an item, which are merged in two steps.

Items go in blocks.  A block is filled with whole items until it holds ``block_postings`` (item, term)
pairs, so what is broadcast has a bounded size however many items there are (one item with more terms
than that is a block of its own).  Every block reads the documents twice: for the document
frequencies of its terms, and to score.  Nothing is sampled or cut; a document is held one at a time,
in slices if it is very long.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pricewh.llm.common import bound_batches, stored
from pricewh.llm.words import word_slices

#: (item, term) pairs of a block; about 60 bytes each in a worker, so 30 MB.
BLOCK_POSTINGS = 500_000
# Fixed values of the score: length normalisation in percent, its divisors and scales.
FLAT, SLOPE, SATURATION, UNIT, WEIGHT_UNIT = 100, 90, 8, 1000, 1000
_DOCUMENTS, _TERMS = -1, -2


@dataclass
class Index:
    """Terms of a block of items: ``slots[starts[t]:starts[t + 1]]`` are the items that hold term t."""
    items: list
    terms: dict[bytes, int]
    starts: np.ndarray
    slots: np.ndarray
    weights: np.ndarray | None = None
    documents: int = 0
    n_terms: int = 0
    kind: pa.DataType | None = None                          # of the item ids


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10,
                   block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank int, doc_id, score long: the ``top`` best documents of each item with a score above 0.

    Equal scores go by ascending doc_id, null ids last.  Every row of ``docs`` is a document of its own,
    repeated ids included; a null or empty text has no terms and is not counted.  Items of one id, the
    null id too, are one item with the terms of all of them; an item without terms, or an empty table,
    gives no rows.  Further columns are not read.
    """
    if top < 1 or block_postings < 1:
        raise ValueError("top and block_postings must be at least 1")
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    best, waiting = [], None
    for index in _blocks(items, block_postings):
        index.kind = to_arrow_type(items.schema["item_id"].dataType)
        if waiting is not None:                              # several blocks: one index at a time
            best.append(stored(_best(texts, waiting, top, kind), "search-block"))
        waiting = index
    if waiting is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    best.append(_best(texts, waiting, top, kind))
    out = best[0]
    for more in best[1:]:
        out = out.unionByName(more)
    return out


def _blocks(items: DataFrame, most: int) -> Iterator[Index]:
    """Indexes of whole items; the (item, term) pairs stream to the driver in item order."""
    pairs = (items.select("item_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
             .mapInArrow(_item_terms, items.select("item_id").schema.add("term", "binary"))
             .distinct().orderBy("item_id", "term"))
    ids: list = []
    postings: dict[bytes, list[int]] = {}
    n = 0
    for item_id, rows in itertools.groupby(pairs.toLocalIterator(), key=lambda r: r.item_id):
        terms = [bytes(r.term) for r in rows]
        if ids and n + len(terms) > most:
            yield _index(ids, postings)
            ids, postings, n = [], {}, 0
        for t in terms:
            postings.setdefault(t, []).append(len(ids))
        ids.append(item_id)
        n += len(terms)
    if ids:
        yield _index(ids, postings)


def _index(ids: list, postings: dict[bytes, list[int]]) -> Index:
    lengths = np.array([len(p) for p in postings.values()], np.int64)
    return Index(ids, {t: i for i, t in enumerate(postings)}, np.concatenate([[0], np.cumsum(lengths)]),
                 np.array([s for p in postings.values() for s in p], np.int64))


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("item_id")
        for i, text in enumerate(b.column("text").to_pylist()):
            for words in word_slices(text):
                terms = list(set(words))
                if terms:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array([i] * len(terms))),
                                                      pa.array(terms, pa.binary())], names=["item_id", "term"])


def _term_counts(text: bytes) -> tuple[int, Counter]:
    n, counts = 0, Counter()
    for words in word_slices(text):
        n += len(words)
        counts.update(words)
    return n, counts


def _best(texts: DataFrame, index: Index, top: int, kind: str) -> DataFrame:
    sc = texts.sparkSession.sparkContext
    terms = sc.broadcast(index.terms)
    found = dict(texts.select("text").mapInArrow(_frequencies(terms), "term long, n long")
                 .groupBy("term").agg(F.sum("n").alias("n")).collect())     # at most a row a term of the block
    terms.unpersist()
    index.documents, index.n_terms = found.pop(_DOCUMENTS, 0), found.pop(_TERMS, 0)
    index.weights = np.array([term_weight(index.documents, found.get(t, 0)) for t in range(len(index.terms))], np.int64)
    heaps = (texts.mapInArrow(_heaps(sc.broadcast(index), top), f"slot long, item_id {kind}, doc_id long, score long")
             .withColumn("salt", F.spark_partition_id() % 64))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["slot", "salt"], ["slot"]):
        heaps = (heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
                 .filter(F.col("rank") <= top))
    return heaps.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def term_weight(documents: int, frequency: int) -> int:
    return math.floor(WEIGHT_UNIT * math.log((2 * documents + 2) / (2 * frequency + 1)))


def length_factor(n: int, documents: int, n_terms: int) -> int:
    """The document's m: 10 for the shortest, 100 for one of average length."""
    return FLAT - SLOPE + (SLOPE * n * documents) // n_terms


def _frequencies(terms):
    """Document frequencies of a task's texts, with the numbers of documents and of terms."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = terms.value, Counter()
        seen = np.zeros(len(known), np.int64)
        for b in batches:
            for text in b.column("text").to_pylist():
                n, counts = _term_counts(text)
                if n:
                    totals[_DOCUMENTS] += 1
                    totals[_TERMS] += n
                    seen[[known[w] for w in counts if w in known]] += 1
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals) + held.tolist(), pa.int64()),
             pa.array(list(totals.values()) + seen[held].tolist(), pa.int64())], names=["term", "n"])
    return run


def _heaps(shared, top: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, best = shared.value, {}
        kind = pa.int64()
        total = np.zeros(len(index.items), np.int64)
        floor = np.ones(len(index.items), np.int64)          # the least score that can still enter a heap
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                n, counts = _term_counts(text)
                slots, added = _contributions(index, n, counts)
                np.add.at(total, slots, added)
                for slot in np.unique(slots[total[slots] >= floor[slots]]).tolist():
                    entry = (int(total[slot]), -math.inf if doc_id is None else -doc_id, doc_id)
                    heap = best.setdefault(slot, [])
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heappushpop(heap, entry) if entry[:2] > heap[0][:2] else None
                    if len(heap) == top:
                        floor[slot] = heap[0][0]
                total[slots] = 0
        names = ["slot", "item_id", "doc_id", "score"]
        for slot, heap in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot] * len(heap), kind), pa.array([index.items[slot]] * len(heap), index.kind),
                 pa.array([e[2] for e in heap], kind), pa.array([e[0] for e in heap], kind)], names=names)
    return run


def _contributions(index: Index, n: int, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Items that the document's terms touch, and what each term adds to each of them."""
    held = [(index.terms[w], tf) for w, tf in counts.items() if w in index.terms]
    if not held:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    term, tf = np.array(held, np.int64).T
    m = length_factor(n, index.documents, index.n_terms)
    gain = index.weights[term] * ((UNIT ** 3 * tf) // (UNIT * tf + SATURATION * m))
    lengths = index.starts[term + 1] - index.starts[term]
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1]) + np.repeat(index.starts[term] - ends + lengths, lengths)
    return index.slots[at], np.repeat(gain, lengths)
