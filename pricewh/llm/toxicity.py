"""Toxic spans by a linear-chain conditional random field (CRF).

Documents are labelled, tokens are not.  A bounded sample of labelled documents gives the token
labels: a word or word beginning is a seed if nearly all documents that hold it are toxic and if
so many are that chance alone would make few such seeds among all words; a token of a toxic document is
toxic if it or its beginning is a seed.  A CRF with two states is trained on windows of such tokens;
its features are hashes of the word and of its beginnings, so inflected forms that were never seen
still count.

A document is tagged whole.  Forward and backward recursions run as odds, for all documents of a
batch at once, longest first.  The marginals give the offending offsets; the largest marginal and
the expected number of toxic tokens give the document's score through a logistic curve that is
fitted on part of the sample which the CRF has not seen.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import bound_batches

#: Bound of the training sample: rows of each label, and code points of a row that may be in it.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_CHARS = 2000, 4000, 20_000
#: Length of hashed beginnings of words, and bits of a hash.
BEGINNINGS, BITS = (4, 5, 6), 18
#: Part of a seed's documents that must be toxic; seeds that chance may make.
SEED_SHARE, CHANCE_SEEDS = 0.9, 1.0
#: Tokens on each side of a labelled one in a training window; rounds and regularisation of training.
AROUND, ROUNDS, L2 = 12, 80, 1e-4
REJECT = 0.7
#: Pieces whose feature weights a worker remembers besides those of the present batch.
REMEMBERED = 300_000
FAR = 15.0

_WORD = re.compile(r"[^\W\d_]+")
_PIECE = re.compile(r"\S+")


@dataclass
class Model:
    """CRF and curve.  ``weight``: of each hashed feature; ``step[a, b]``: of state a before state b."""

    weight: np.ndarray
    bias: float
    start: float
    step: np.ndarray
    curve: np.ndarray


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted, spans (start and length of toxic tokens in code points), row.

    A null or empty text has no tokens and gets the curve's lowest score.  Each row is scored on its
    own; an empty table gives no rows; only the text is an input of the score.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.struct(*docs.columns).alias("row"))
    span = "array<struct<start: int, length: int>>"
    schema = rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                         F.lit(None).cast(span).alias("spans"), "row").schema
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            scores, spans = tagger.score(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= REJECT) for s in scores], pa.int32()), pa.array(spans, span_type), b.column("row")],
                names=["doc_id", "score", "predicted", "spans", "row"])

    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows that no label is learned from: crc32 of the id as text leaves 1 when divided by 3.  A null id is not one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Model of a bounded sample of the labelled rows that are not held out.

    Of each label the rows with the smallest hash of their id are taken.  An id with several labels
    counts as toxic if one says so; rows without id or label are left out.  Only ids come to the
    driver first; then the texts of at most TOXIC_ROWS + CLEAN_ROWS rows of at most SAMPLE_CHARS.
    """
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("at", F.xxhash64("doc_id")))
    ids = [r for toxic, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
           for r in known.filter(F.col("toxic") == toxic).orderBy("at", "doc_id").limit(most).collect()]
    if not ids:
        return train([], [])
    chosen = F.broadcast(spark.createDataFrame([(r.doc_id, r.toxic) for r in ids],
                                               known.select("doc_id", "toxic").schema))
    sample = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
              .filter(F.length("text") <= SAMPLE_CHARS).join(chosen, "doc_id")
              .select("doc_id", "text", "toxic").collect())
    sample = sorted({r.text: r for r in sorted(sample, key=lambda r: -r.doc_id)}.values(), key=lambda r: r.doc_id)
    return train([r.text for r in sample], [int(r.toxic) for r in sample])


def features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) & (1 << BITS) - 1 for f in features(word)]


def words_of(piece: str) -> list[str]:
    low = piece.lower()
    return [low] if low.isalpha() else _WORD.findall(low)


class Tagger:
    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.step = np.exp(model.step)

    def emissions(self, text: str) -> list[float]:
        known, out = self.known, []
        for piece in text.split():
            e = known.get(piece)
            if e is None:
                w = self.model.weight
                e = known[piece] = self.model.bias + max((float(w[slots(x)].sum()) for x in words_of(piece)), default=0.0)
            out.append(e)
        return out

    def score(self, texts: list[str]) -> tuple[list[float], list[list[dict]]]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        rows = [self.emissions(t) for t in texts]
        logits = self.marginals(rows)
        scores, spans = [], []
        for text, own in zip(texts, logits):
            scores.append(curve_at(self.model.curve, document_features(own)))
            toxic = set(np.flatnonzero(own > 0).tolist())
            spans.append([{"start": m.start(), "length": len(m[0])} for i, m in enumerate(_PIECE.finditer(text))
                          if i in toxic] if toxic else [])
        return scores, spans

    def marginals(self, rows: list[list[float]]) -> list[np.ndarray]:
        """Log odds of the toxic state for each token of each row."""
        order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
        lengths = np.array([len(rows[i]) for i in order])
        total, out = int(lengths.sum()), [np.empty(0)] * len(rows)
        if not total:
            return out
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")     # rows longer than t
        first = np.concatenate([[0], np.cumsum(active)])                            # tokens lie by position, then row
        flat = np.empty(total)
        for k, i in enumerate(order):
            flat[first[:len(rows[i])] + k] = rows[i]
        odds = np.exp(np.clip(flat, -FAR, FAR))
        (s00, s01), (s10, s11) = self.step
        ahead, behind = np.empty(total), np.empty(total)
        o = np.full(len(rows), math.exp(self.model.start))
        for t, n in enumerate(active):
            a = first[t]
            if t:
                o = o[:n]
                o = (s01 + s11 * o) / (s00 + s10 * o)
            else:
                o = o[:n]
            o = o * odds[a:a + n]
            ahead[a:a + n] = o
        b = np.ones(0)
        for t in range(len(active) - 1, -1, -1):
            a, n = first[t], active[t]
            if len(b) < n:
                b = np.concatenate([b, np.ones(n - len(b))])
            behind[a:a + n] = b
            ob = odds[a:a + n] * b
            b = (s10 + s11 * ob) / (s00 + s01 * ob)
        logit = np.log(ahead) + np.log(behind)
        for k, i in enumerate(order):
            out[i] = logit[first[:len(rows[i])] + k]
        return out


def document_features(logits: np.ndarray) -> np.ndarray:
    """1, the largest log odds (scaled), log of 1 + the expected number of tokens that are likelier toxic."""
    if not len(logits):
        return np.array([1.0, -1.0, 0.0])
    top = logits[logits > 0]
    return np.array([1.0, float(np.clip(logits.max(), -FAR, FAR)) / FAR, math.log1p(float((1 / (1 + np.exp(-top))).sum()))])


def curve_at(curve: np.ndarray, x: np.ndarray) -> float:
    return 1 / (1 + math.exp(-float(np.clip(curve @ x, -30, 30))))


def train(texts: list[str], toxic: list[int]) -> Model:
    """Without documents of both labels, or without windows, the model knows nothing: it scores the share of toxic
    ones, 0.5 at most, so that it rejects no document."""
    y = np.array(toxic)
    share = min((y.sum() + 0.5) / (len(y) + 1), 0.5) if len(y) else 0.0
    nothing = Model(np.zeros(1 << BITS, np.float32), -FAR, 0.0, np.zeros((2, 2)),
                    np.array([math.log(max(share, 1e-9) / (1 - share)), 0.0, 0.0]))
    if len(set(toxic)) < 2:
        return nothing
    sample = Sample(texts)
    fold = np.arange(len(y)) % 4 == 3                      # for the curve
    fit_on = [(d, t) for d, t, f, own in zip(sample.docs, toxic, fold, sample.unlike()) if own and not f]
    seed = sample.seed_pieces(fit_on)
    windows, tags = token_windows(fit_on, seed)
    if not windows:
        return nothing
    model = train_crf([[sample.words[i][0] if sample.words[i] else "" for i in w] for w in windows], tags)
    tagger = Tagger(model)
    x = np.array([document_features(m)
                  for m in tagger.marginals([tagger.emissions(t) for t, f in zip(texts, fold) if f])])
    model.curve = fit_curve(x, y[fold])
    return model


class Sample:
    """Texts as numbers of their different pieces, and the features of each piece."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        self.docs = [np.array([number.setdefault(p, len(number)) for p in t.split()], np.int32) for t in texts]
        self.words = [words_of(p) for p in number]
        known: dict[str, int] = {}
        own = [sorted({known.setdefault(f, len(known)) for w in words for f in features(w)}) for words in self.words]
        self.n_features = len(known)
        self.begin = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        self.feature = np.array([f for x in own for f in x], np.int32)

    def unlike(self, hashes: int = 4) -> list[bool]:
        """Whether a text shares no smallest hash of its piece triples with an earlier one: near copies of
        one toxic text would make seeds of all its words."""
        seen, out = set(), []
        factors = [0x9E3779B97F4A7C15 + 2 * k * 0x5851F42D4C957F2D | 1 for k in range(hashes)]
        for d in self.docs:
            d = d.astype(np.uint64)
            triples = d if len(d) < 3 else (d[:-2] * np.uint64(1_000_003) + d[1:-1]) * np.uint64(1_000_003) + d[2:]
            own = {(k, int((triples * np.uint64(f & (1 << 64) - 1)).min())) for k, f in enumerate(factors)} if len(d) else set()
            out.append(not own & seen)
            seen |= own
        return out

    def seed_pieces(self, docs: list[tuple[np.ndarray, int]]) -> np.ndarray:
        """For each piece whether one of its features is a seed."""
        held = np.zeros((2, self.n_features), np.int32)
        for pieces, toxic in docs:
            pieces = np.unique(pieces)
            n = self.begin[pieces + 1] - self.begin[pieces]
            at = np.repeat(self.begin[pieces] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            held[int(bool(toxic)), np.unique(self.feature[at])] += 1
        base = max(sum(1 for _, t in docs if t), 1) / len(docs)
        least = max(3, math.ceil(math.log(max(int((held[1] > 0).sum()), 2) / CHANCE_SEEDS) / -math.log(min(base, 0.5))))
        seeds = (held[1] >= least) & (held[1] >= SEED_SHARE * (held.sum(axis=0) + 0.5))
        hit = np.concatenate([[0], np.cumsum(seeds[self.feature])])
        return hit[self.begin[1:]] > hit[self.begin[:-1]]


def token_windows(docs: list[tuple[np.ndarray, int]], seed: np.ndarray) -> tuple[list[np.ndarray], list[list[int]]]:
    """Windows around the seeds of toxic documents and around like tokens of clean ones, and evenly spaced clean ones."""
    windows, tags = [], []
    for pieces, toxic in docs:
        hit = seed[pieces] if len(pieces) else np.zeros(0, bool)
        middles = np.flatnonzero(hit)[:20].tolist()
        if not toxic or not middles:
            middles += list(range(AROUND, len(pieces), max(4 * AROUND, len(pieces) // 3)))
        for i in middles:
            a, b = max(0, i - AROUND), i + AROUND + 1
            windows.append(pieces[a:b])
            tags.append([int(h) for h in hit[a:b] & bool(toxic)])
    return windows, tags


def train_crf(windows: list[list[str]], tags: list[list[int]]) -> Model:
    """Maximum likelihood with L2, by Adam over all windows at once."""
    n, length = len(windows), max(map(len, windows))
    per = 1 + len(BEGINNINGS)
    dummy = 1 << BITS                                       # a slot whose weight stays 0
    slot = np.full((n, length, per), dummy, np.int32)
    tag, inside = np.zeros((n, length), np.int8), np.zeros((n, length), bool)
    memo: dict[str, list[int]] = {}
    for i, (ws, ts) in enumerate(zip(windows, tags)):
        for t, w in enumerate(ws):
            own = memo.get(w)
            if own is None:
                own = memo[w] = slots(w) if w else []
            slot[i, t, :len(own)] = own
        tag[i, :len(ts)], inside[i, :len(ts)] = ts, True
    used, slot = np.unique(slot, return_inverse=True)
    slot = slot.reshape(n, length, per)
    at_dummy = int(np.searchsorted(used, dummy))
    theta = np.zeros(len(used) + 6)                         # weights, bias, start, step[4]
    theta[-6] = -2.0
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, ROUNDS + 1):
        grad = -_gradient(theta, slot, tag, inside) / n + L2 * theta
        if at_dummy < len(used) and used[at_dummy] == dummy:
            grad[at_dummy] = 0
        moment = 0.9 * moment + 0.1 * grad
        square = 0.99 * square + 0.01 * grad ** 2
        theta -= 0.3 * (moment / (1 - 0.9 ** r)) / (np.sqrt(square / (1 - 0.99 ** r)) + 1e-8)
    weight = np.zeros(1 << BITS, np.float32)
    keep = used < dummy
    weight[used[keep]] = theta[:-6][keep]
    return Model(weight, float(theta[-6]), float(theta[-5]), theta[-4:].reshape(2, 2).copy(), np.zeros(3))


def _gradient(theta: np.ndarray, slot: np.ndarray, tag: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Of the log likelihood: observed minus expected features, by forward and backward recursions."""
    n, length, _ = slot.shape
    weight, bias, start, step = theta[:-6], theta[-6], theta[-5], np.exp(theta[-4:].reshape(2, 2))
    e = np.clip(weight[slot].sum(axis=2) + bias, -FAR, FAR)
    local = np.stack([np.ones_like(e), np.exp(e)], axis=2)  # of both states
    local[~inside] = 1.0
    alpha, beta, scale = np.empty((length, n, 2)), np.empty((length, n, 2)), np.empty((length, n))
    for t in range(length):
        a = local[:, t] * (np.array([1.0, math.exp(start)]) if t == 0 else alpha[t - 1] @ step)
        if t:
            a = np.where(inside[:, t, None], a, alpha[t - 1])
        scale[t] = a.sum(axis=1)
        alpha[t] = a / scale[t][:, None]
    beta[-1] = 1.0
    for t in range(length - 2, -1, -1):
        b = (local[:, t + 1] * beta[t + 1]) @ step.T
        b = np.where(inside[:, t + 1, None], b, 1.0)
        beta[t] = b / b.sum(axis=1, keepdims=True)
    grad = np.zeros_like(theta)
    p = alpha * beta
    p1 = (p[..., 1] / p.sum(axis=2)).T
    off = np.where(inside, tag - p1, 0.0)
    grad[:-6] = np.bincount(slot.ravel(), np.repeat(off.ravel(), slot.shape[2]), len(weight))
    grad[-6] = off.sum()
    grad[-5] = off[:, 0].sum()
    for t in range(1, length):
        m = inside[:, t]
        joint = alpha[t - 1][:, :, None] * step * (local[:, t] * beta[t])[:, None, :]
        joint = (joint / joint.sum(axis=(1, 2), keepdims=True))[m].sum(axis=0)
        seen = np.bincount(2 * tag[m, t - 1] + tag[m, t], minlength=4).reshape(2, 2)
        grad[-4:] += (seen - joint).ravel()
    return grad


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small penalty, by Newton steps."""
    curve = np.zeros(x.shape[1])
    penalty = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ curve)
        curve += np.clip(step, -4, 4)
    return curve
