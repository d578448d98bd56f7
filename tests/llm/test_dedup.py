"""Exact, line and near-duplicate operators against plain Python."""

import hashlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import SMALL, texts_of
from pricewh.llm import embedding_dedup, exact_dedup, line_dedup, ngram_join
from pricewh.llm.partenum import Scheme


def _low(text):
    return (text or "").encode().lower().decode()


def _rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def _exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_low(t), []).append(i)
    out = []
    for i, t in rows:
        own = groups[_low(t)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256(_low(t).encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_dedup(awkward, empty):
    assert _rows(exact_dedup.exact_dedup(awkward), *EXACT) == _exact(texts_of(awkward))
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_compares_texts_where_digests_collide(awkward):
    one_digest = exact_dedup.exact_dedup(awkward, digest=lambda norm: F.lit("x"))
    assert _rows(one_digest, *EXACT) == _exact(texts_of(awkward))


def test_drop_exact_duplicates_keeps_columns(awkward):
    kept = exact_dedup.drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {x[0] for x in _exact(texts_of(awkward)) if x[3]}


def _lines(rows):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
            if i is not None and len(key) >= 10:
                holders.setdefault(key, set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or not (
            (h := holders.get(x.strip(" \t\n\x0b\x0c\r").encode().lower().decode())) and len(h) > 1 and i > min(h))]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,fanout", [(4, 2), (5, 3)])
def test_line_dedup(awkward, batches, fanout):
    got = line_dedup.dedup_lines(awkward, batches=batches, fanout=fanout)
    assert _rows(got, "doc_id", "text", "n_lines", "n_dropped") == _lines(texts_of(awkward))
    assert got.select("row.*").columns == awkward.columns


def test_line_dedup_of_nothing(empty):
    assert line_dedup.dedup_lines(empty).count() == 0


def test_runs_are_merged_by_level(spark):
    runs = line_dedup.SortedRuns(fanout=2)
    for b in range(5):
        batch = spark.createDataFrame([(i, bytes([j])) for i in range(b * 10, b * 10 + 3) for j in (0, b, b + 1)],
                                      "doc_id long, h binary")
        lost = {(bytes(r.h), r.holder) for r in runs.add(batch).collect()}
        assert (bytes([0]), 0) in lost
    assert [len(level) for level in runs.levels] == [1, 0, 1]


def _components(ids, links):
    least = {i: i for i in ids}
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least


def _jaccard(rows, width, of):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    ids = [i for i in sets if i is not None]
    links = [(a, b) for a, b in combinations(ids, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= of * len(sets[a] | sets[b])]
    least = _components(ids, links)
    return sorted(((i, len(sets[i]), least.get(i)) for i, _ in rows if i is not None), key=repr)


def test_ngram_join_on_awkward_rows(awkward, empty):
    got = ngram_join.jaccard_components(awkward, width=4, of=85)
    assert [r for r in _rows(got, "doc_id", "n_shingles", "component_id") if r[0] is not None] == _jaccard(
        texts_of(awkward), 4, 85)
    assert {r.component_id for r in got.filter("doc_id IS NULL").collect()} == {None}
    assert ngram_join.jaccard_components(empty).count() == 0
    assert ngram_join.one_of_each(awkward).columns == awkward.columns


def test_ngram_join_finds_all_links_of_chains_of_edits(spark):
    rng = np.random.default_rng(3)
    rows, words = [], [f"w{i}" for i in range(400)]
    for family in range(12):
        text = list(rng.choice(words, rng.integers(6, 220)))
        for copy in range(8):
            rows.append((int(len(rows)), " ".join(text)))
            for _ in range(rng.integers(0, 4)):
                text[rng.integers(0, len(text))] = str(rng.choice(words))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width, of in ((4, 85), (5, 80)):
        got = ngram_join.jaccard_components(df, width=width, of=of)
        assert _rows(got, "doc_id", "n_shingles", "component_id") == _jaccard(rows, width, of)


@pytest.mark.parametrize("of", [80, 85, 95])
def test_similar_sets_share_a_signature(of):
    rng = np.random.default_rng(of)
    scheme = Scheme(of, 100, 3000)
    for _ in range(400):
        n = int(rng.integers(1, 40) if rng.random() < 0.6 else rng.integers(40, 2500))
        common = rng.integers(0, 1 << 62, n).astype(np.uint64)
        a, b = common.copy(), common.copy()
        room = n * (100 - of) // of                      # features that may differ in all
        extra = int(rng.integers(0, room + 1)) if rng.random() < 0.5 else room
        own = rng.integers(0, 1 << 62, extra).astype(np.uint64)
        cut = int(rng.integers(0, extra + 1))
        a, b = (np.unique(np.concatenate([x, y])) for x, y in ((a, own[:cut]), (b, own[cut:])))
        assert 100 * len(np.intersect1d(a, b)) >= of * len(np.union1d(a, b))
        sig, row = scheme.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert set(sig[row == 0]) & set(sig[row == 1]), (len(a), len(b), extra)


def test_embedding_dedup(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(30):
        middle = rng.standard_normal(16)
        for _ in range(8):
            rows.append((len(rows), [float(x) for x in middle + 0.2 * rng.standard_normal(16)], c % 3))
    nan, inf = float("nan"), float("inf")
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [nan] * 16, 1), (n + 3, [inf] + [1.0] * 15, 1),
             (n + 4, [None] + [1.0] * 15, 1), (n + 5, rows[0][1], None), (n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0),
             (n + 8, [], 0), (None, rows[0][1], 0), (n + 9, [x * 1e300 for x in rows[0][1]], 0), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.select("*", F.lit(1).alias("n_links"), F.lit(1).alias("y"), F.lit(1).alias("block"))
    unit = {}
    for i, x, label in rows:
        if i is not None and x and label is not None and all(v is not None and np.isfinite(v) for v in x) and any(x):
            x = np.array(x) / np.abs(x).max()
            unit[i] = (label, x / np.linalg.norm(x))
    links = [(a, b) for a, b in combinations(unit, 2) if unit[a][0] == unit[b][0]
             and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.93]
    least = _components([r[0] for r in rows if r[0] is not None], links)
    degree = {i: sum(i in p for p in links) for i in least}
    want = sorted(((i, degree.get(i, 0), least.get(i), least.get(i) == i) for i, _, _ in rows), key=repr)
    got = embedding_dedup.near_duplicates(df)
    assert len(links) > 50 and _rows(got, "vec_id", "n_links", "component_id", "kept") == want
    assert embedding_dedup.near_duplicates(df.filter("false")).count() == 0


def test_tiles_stop_early_but_lose_no_pair():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((300, 24))
    a[100:140] = a[0] + 0.05 * rng.standard_normal((40, 24))
    a /= np.linalg.norm(a, axis=1)[:, None]
    i, j = embedding_dedup.linked_pairs(a, a, 0.93, True)
    x, y = np.nonzero(np.triu(a @ a.T >= 0.93, 1))
    assert sorted(zip(i, j)) == sorted(zip(x, y)) and len(i) > 500
    i, j = embedding_dedup.linked_pairs(a[:50], a[90:], 0.93, False)
    x, y = np.nonzero(a[:50] @ a[90:].T >= 0.93)
    assert sorted(zip(i, j)) == sorted(zip(x, y)) and len(i) > 10


def test_small_table_against_plain_python(spark):
    rows = texts_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(line_dedup.dedup_lines(df), "doc_id", "text", "n_lines", "n_dropped") == _lines(rows)


def test_pairs_at_the_threshold_and_one_step_below(spark):
    """Cosines of exactly 0.93 link, the next smaller doubles do not, as in the comparison of the SQL."""
    import duckdb
    rng, rows, labels = np.random.default_rng(3), [], []
    for k in range(60):
        order = rng.permutation(15)
        unit, other = np.zeros(16), np.zeros(16)
        unit[0], other[0] = 1.0, 93.0
        other[1 + order[:4]] = 35.0, 11.0, 2.0, 1.0
        other *= 2.0 ** rng.integers(-400, 400)
        if k % 3 == 1:
            other[1 + order[4]] = abs(other[0]) * 2e-8          # a hair longer: the cosine falls below
        if k % 3 == 2:
            unit[1 + order[0]] = 1e-9                           # a hair nearer
        for v in (unit, other):
            rows.append((len(rows), v.tolist(), f"l{k}"))
    con = duckdb.connect()
    want = {}
    for k in range(60):
        (a, x, _), (b, y, _) = rows[2 * k:2 * k + 2]
        y = np.ldexp(np.array(y), -int(np.frexp(max(map(abs, y)))[1])).tolist()      # DuckDB's sums would overflow
        want[a] = want[b] = con.execute("SELECT list_cosine_similarity(?::DOUBLE[], ?::DOUBLE[]) >= 0.93", [x, y]).fetchone()[0]
    assert 20 <= sum(want.values()) // 2 < 60 and not any(want[2 * k] for k in range(60) if k % 3 == 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r.n_links == 1 for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == want
