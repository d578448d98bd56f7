"""Ranked lexical search against plain Python."""

import math
import re
from collections import Counter

import pytest

from pricewh.llm import ranked_search, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
AZ = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _terms(text):
    return TERM.findall((text or "").translate(AZ))


def brute(docs, items, top):
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(_terms(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, c in counts:
            n = sum(c.values())
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def _rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    from pyspark.sql import functions as F
    rows = [(1, "the quick brown FOX"), (2, "shared line of text"), (2, "walks home"), (3, None), (4, " .,! "),
            (None, "long line"), (5, "Äö Σας ÄÖ é x"), (6, "zzz nothing"), (7, "w" * 70_000), (8, "the the the of")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("score", F.lit(1)).withColumn("rank", F.lit(2))


def _texts(df, key):
    return [(r[key], r.text) for r in df.collect()]


@pytest.mark.parametrize("top,block", [(10, 500_000), (2, 500_000), (1, 3), (3, 5)])
def test_search_against_brute_force(awkward, items, top, block):
    docs = awkward.repartition(5)
    got = _rows(ranked_search.rank_documents(docs, items, top, block))
    assert got == brute(_texts(awkward, "doc_id"), _texts(items, "item_id"), top)


def test_ties_go_by_document_id_over_many_tasks(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000, "same")] + [(None, "same words here")]
    items = [(1, "words here"), (2, "here")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = _rows(ranked_search.rank_documents(frame, spark.createDataFrame(items, "item_id long, text string"), 5))
    assert got == brute(docs, items, 5)
    assert [r[2] for r in sorted(got)[:5]] == [1, 2, 3, 4, 5]


def test_empty_tables(awkward, empty, items):
    assert ranked_search.rank_documents(empty, items).count() == 0
    none = ranked_search.rank_documents(awkward, items.filter("false"))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    with pytest.raises(ValueError):
        ranked_search.rank_documents(awkward, items, top=0)


def test_words_of_long_texts_are_not_cut(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 10)
    text = "Alpha beta,GAMMA " * 20 + "x" * 50 + " ünï \x80z"
    assert [w.decode() for s in words.word_slices(text.encode()) for w in s] == _terms(text)


def test_blocks_hold_whole_items(spark, items):
    sizes = [(i.items, len(i.slots)) for i in ranked_search._blocks(items, 5)]
    assert [x for ids, _ in sizes for x in ids] == [None, 1, 2, 5, 6, 7, 8]
    assert all(n <= 5 or len(ids) == 1 for ids, n in sizes)
