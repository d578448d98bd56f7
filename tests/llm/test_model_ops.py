"""Toxicity tagger, language model and the pipeline: exact parts by brute force, trained parts on held-out rows."""

import itertools
import math
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers

from conftest_llm import SMALL, texts_of
from pricewh.llm import attention_lm as lm
from pricewh.llm import toxicity as tox
from pricewh.llm.bpe import codec
from pricewh.llm.common import DROP_SHUFFLES

PATH = public_tokenizers.path("word_bpe_49k.json")
MID = "/root/testdata/sf0.1"


def _model(rng):
    return tox.Model(rng.standard_normal(1 << tox.BITS).astype(np.float32), -0.5, -0.3, rng.standard_normal((2, 2)), np.zeros(3))


def test_marginals_equal_enumeration():
    model = _model(np.random.default_rng(2))
    tagger = tox.Tagger(model)
    rows = [tagger.emissions(t) for t in ("a bb ccc dddd", "", "one two three four five six seven", "x")]
    got = tagger.marginals(rows)
    for e, logits in zip(rows, got):
        mass = np.zeros((len(e), 2))
        for tags in itertools.product((0, 1), repeat=len(e)):
            s = sum(x for x, t in zip(e, tags) if t) + (model.start if tags and tags[0] else 0)
            s += sum(model.step[a, b] for a, b in zip(tags, tags[1:]))
            for i, t in enumerate(tags):
                mass[i, t] += math.exp(s)
        assert np.allclose(logits, np.log(mass[:, 1] / mass[:, 0]) if len(e) else [])


def test_crf_gradient():
    rng = np.random.default_rng(0)
    slot, tag = rng.integers(0, 5, (4, 6, 2)), rng.integers(0, 2, (4, 6)).astype(np.int8)
    inside = np.ones((4, 6), bool)
    inside[1, 4:] = False
    tag[~inside] = 0
    theta = rng.standard_normal(11) * 0.5

    def likelihood(theta):
        total = 0.0
        for s, t, n in zip(slot, tag, inside.sum(axis=1)):
            def score(tags):
                e = theta[:5][s[:n]].sum(axis=1) + theta[5]
                return (sum(x for x, y in zip(e, tags) if y) + (theta[6] if tags[0] else 0)
                        + sum(theta[7:].reshape(2, 2)[a, b] for a, b in zip(tags, tags[1:])))
            total += score(tuple(t[:n])) - math.log(sum(math.exp(score(x)) for x in itertools.product((0, 1), repeat=n)))
        return total

    grad = tox._gradient(theta, slot, tag, inside)
    for i in range(len(theta)):
        step = np.zeros(len(theta))
        step[i] = 1e-5
        assert math.isclose(grad[i], (likelihood(theta + step) - likelihood(theta - step)) / 2e-5, rel_tol=1e-4, abs_tol=1e-6)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    model = tox.fit(docs, labels)
    scored = tox.score_documents(docs.join(labels, "doc_id", "left_semi"), model)
    rows = scored.join(labels, "doc_id").select("doc_id", "score", "toxic", "spans", tox.held_out().alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    bad = [r.score for r in rows if r.out and r.toxic]
    good = np.array([r.score for r in rows if r.out and not r.toxic])
    assert np.mean([(good < b).mean() + (good == b).mean() / 2 for b in bad]) > 0.9
    assert (good >= tox.REJECT).mean() < 0.02 and np.mean(np.array(bad) >= tox.REJECT) > 0.75
    assert any(r.spans for r in rows if r.toxic)


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (6, None), (7, 0)], "doc_id long, toxic int")
    model = tox.fit(awkward, labels)
    rows = tox.score_documents(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert tox.score_documents(empty, model).count() == 0
    assert 0 <= tox.score_documents(awkward, tox.fit(awkward, labels.filter("false"))).first().score <= 1
    assert tox.score_documents(awkward, model).select("row.*").columns == awkward.columns


def test_labels_of_one_kind_reject_nothing(spark, awkward, tmp_path):
    import corpus_pipeline
    labels = spark.createDataFrame([(i, 1) for i in range(1, 15)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, awkward, str(tmp_path))
    assert kept.count() == awkward.count()


def test_spans_point_at_pieces():
    model = tox.Model(np.zeros(1 << tox.BITS, np.float32), -3.0, 0.0, np.zeros((2, 2)), np.array([0.0, 1.0, 1.0]))
    model.weight[tox.slots("scum")[0]] = 9.0
    text = "You are  SCUM, he said:\nscum!"
    (score,), (spans,) = tox.Tagger(model).score([text])
    assert [text[s["start"]:s["start"] + s["length"]] for s in spans] == ["SCUM,", "scum!"]


@pytest.fixture(scope="module")
def network():
    rng = np.random.default_rng(0)
    words = ["ba", "do", "re", "mi", "fa", "sol"]
    texts = [" ".join(words[(i + k) % 6] for k in range(n)) for i, n in enumerate(rng.integers(1, 150, 80))]
    steps, lm.STEPS = lm.STEPS, 60
    try:
        return lm.train_network(texts, PATH), texts
    finally:
        lm.STEPS = steps


def test_probabilities_add_up_to_one(network):
    net, _ = network
    ids = np.arange(len(net.cls))
    some = np.random.default_rng(1).choice(ids, 20)
    has_ids = np.bincount(net.cls, minlength=lm.CLASSES) > 0
    for before in [*some, *codec(PATH).special.values()]:
        in_class = np.bincount(net.cls, np.exp(net.log_in_class(np.full(len(ids), before), ids)), lm.CLASSES)
        assert np.allclose(in_class[has_ids], 1)
    batch = np.random.default_rng(2).choice(ids, (2, lm.WINDOW))
    logits = lm._forward(net, batch)[4].astype(float)
    p = np.exp(logits - logits.max(axis=-1, keepdims=True))
    assert (p / p.sum(axis=-1, keepdims=True))[..., ~has_ids].max(initial=0) < 1e-6


def test_attention_is_causal_and_helps(network):
    net, texts = network
    a = np.random.default_rng(3).integers(0, 1000, (1, lm.WINDOW))
    b = a.copy()
    b[0, 20:] = 7
    assert np.allclose(lm._forward(net, a)[4][0, :20], lm._forward(net, b)[4][0, :20], atol=1e-5)
    stream = lm.Stream(pa.array(texts), codec(PATH))
    n = len(stream.ids) - len(texts)
    assert lm.log10_scores(net, stream).sum() / n > -1.0


def test_prepared_layers_give_the_same_logits(network):
    net, _ = network
    ids = np.random.default_rng(5).integers(0, len(net.cls), (3, lm.WINDOW))
    whole = lm._forward(net, ids)[4]
    for first in (0, lm.CONTEXT):
        assert np.allclose(lm.Layers(net).logits(ids, first), whole[:, first:], atol=1e-3, rtol=1e-4)
    before, after = np.divmod(net.cells[::7], len(net.cls))
    before = np.concatenate([np.flatnonzero(net.group == before[0])[:1], ids[0]])
    after = np.concatenate([after[:1], ids[1]])
    assert np.allclose(lm.Layers(net).log_in_class(before, after), net.log_in_class(before, after), atol=1e-4)


def test_attention_gradient(network):
    net, _ = network
    rng = np.random.default_rng(4)
    ids = rng.choice(np.flatnonzero(net.slot), (3, lm.WINDOW))
    target, real = rng.integers(0, lm.CLASSES, ids.shape), rng.random(ids.shape) < 0.8
    weights = {k: v.astype(np.float64) for k, v in net.p.items()}
    own = lm.Network(net.slot, net.cls, net.group, weights, net.prior.astype(float))

    def loss():
        logits = lm._forward(own, ids)[4]
        top = logits.max(axis=-1, keepdims=True)
        log_p = logits - top - np.log(np.exp(logits - top).sum(axis=-1, keepdims=True))
        return -(np.take_along_axis(log_p, target[..., None], -1)[..., 0] * real).sum() / real.sum()

    grads = lm._gradients(own, ids, target, real)
    for name, g in grads.items():
        at = tuple(int(rng.integers(0, s)) for s in g.shape) if name != "embed" else (int(net.slot[ids[0, 0]]), 3)
        weights[name][at] += 1e-4
        up = loss()
        weights[name][at] -= 2e-4
        down = loss()
        weights[name][at] += 1e-4
        assert math.isclose(g[at], (up - down) / 2e-4, rel_tol=2e-2, abs_tol=2e-5), name


def test_gradient_computes_no_weights_ahead_of_a_span(network, monkeypatch):
    """Of a window's WINDOW * WINDOW products of places a quarter lies ahead and is left out; all places still learn."""
    net, _ = network
    ids = np.random.default_rng(6).choice(np.flatnonzero(net.slot), (3, lm.WINDOW))
    exp, met = np.exp, []
    monkeypatch.setattr(lm.np, "exp", lambda x, **kw: (met.append(x.size), exp(x, **kw))[1])
    grads = lm._gradients(net, ids, net.cls[ids[:, ::-1]], np.ones(ids.shape, bool))
    assert sum(met) == ids.size * (lm.CLASSES + lm.WINDOW * 3 // 4)
    assert grads["place"].all() and grads["embed"][net.slot[ids]].all()


@pytest.mark.parametrize("far", [0.0, 200.0])
def test_gradient_is_the_same_where_exp_would_overflow(network, far):
    """Against each class's probability by the plain forward pass, with a bias of all classes that changes nothing."""
    net, _ = network
    rng = np.random.default_rng(8)
    ids = rng.choice(np.flatnonzero(net.slot), (2, lm.WINDOW))
    target, real = rng.integers(0, lm.CLASSES, ids.shape), rng.random(ids.shape) < 0.7
    moved = lm.Network(net.slot, net.cls, net.group, net.p | {"bias": net.p["bias"] + np.float32(far)}, net.prior)
    logits = lm._forward(net, ids)[4].astype(float)
    prob = np.exp(logits - logits.max(axis=-1, keepdims=True))
    prob /= prob.sum(axis=-1, keepdims=True)
    want = (prob[real].sum(axis=0) - np.bincount(target[real], minlength=lm.CLASSES)) / real.sum()
    got, plain = lm._gradients(moved, ids, target, real), lm._gradients(net, ids, target, real)
    assert np.allclose(got["bias"], want, atol=1e-4)
    assert all(np.allclose(got[k], plain[k], atol=1e-4 * np.abs(plain[k]).max() + 1e-6, rtol=1e-3) for k in plain)


def test_windows_score_each_id_once():
    w, c = lm.WINDOW, lm.CONTEXT
    lengths = [1, 2, w - 1, w, w + 1, w + 2, 2 * w - c, 2 * w - c + 1, 400]
    offset = np.concatenate([[0], np.cumsum([n + 1 for n in lengths])])
    begin, row = lm.windows(offset)
    for r, n in enumerate(lengths):
        own = begin[row == r] - offset[r]
        scored = [t for k, b in enumerate(own) for t in range(b + (lm.CONTEXT if k else 0), min(b + lm.WINDOW, n))]
        assert scored == list(range(n))


def test_ids_of_long_rows_are_scored_with_context():
    n = 1000
    begin, _ = lm.windows(np.array([0, n + 1]))
    context = [t - b for k, b in enumerate(begin) for t in range(b + (lm.CONTEXT if k else 0), min(b + lm.WINDOW, n))]
    assert min(context[16:]) >= 16 and max(context) >= 63


def test_model_learns_from_all_training_rows(spark, monkeypatch):
    """The end of a row of more than 20,000 characters, and rows past the first 1,500, are learned from too."""
    rare, late = "quixotic zymurgy", "jabberwock vorpal"
    rows = [(i, "the cat sat on the mat") for i in range(2000)]
    rows += [(2001, "the cat " * 4000 + rare), *((i, late) for i in range(3000, 3005))]
    rows = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    assert {2001, 3000} <= {i for i, _ in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    stream = lm.Stream(pa.array([t for _, t in rows]), codec(PATH))
    monkeypatch.setattr(lm, "STEPS", 10)
    monkeypatch.setattr(lm, "BATCH", 8)
    net, drawn, workers = lm.classed_network(lm.id_rows(docs.select("text"), PATH), PATH)
    assert workers > 1                                          # grows with the windows
    seen = np.unique(stream.ids)
    assert (net.slot[seen] > 0).all() and (net.slot > 0).sum() == len(seen)
    in_one = lm.network_of(np.bincount(stream.ids, minlength=len(net.cls)),
                           *lm.neighbour_counts(stream, lm.common_ids(np.bincount(stream.ids, minlength=len(net.cls)))))
    assert (net.cls == in_one.cls).all() and (net.group == in_one.group).all()
    windows = np.concatenate([np.frombuffer(r.windows, np.int32).reshape(-1, lm.WINDOW + 1) for r in drawn.collect()])
    assert 0.5 < len(windows) / max(lm.SHARE * len(lm.first_ids(stream)), lm.STEPS * lm.BATCH) < 1.5
    lm.finish(net, *lm.cell_counts(net, stream))
    start, before = net.p, lm.log10_scores(net, stream).sum()
    lm.train_in_rounds(net, drawn, workers)
    used = np.unique(windows[:, :-1][windows[:, 1:] >= 0])
    assert (net.p["embed"][net.slot[used]] != start["embed"][net.slot[used]]).any(axis=1).all()
    assert lm.log10_scores(net, stream).sum() > before


def test_attention_is_trained_on_every_window(spark, monkeypatch):
    """Each id of a training row but the first is a target once a pass, and each worker takes all its windows."""
    texts = [" ".join(f"w{(i * 7 + k) % 50}" for k in range(n)) for i, n in enumerate([0, 1, 20, 63, 64, 65, 400, 3000])]
    stream = lm.Stream(pa.array(texts), codec(PATH))
    whole = lm.training_windows(stream)
    assert (whole[:, 1:] >= 0).sum() == len(stream.ids) - len(texts)
    monkeypatch.setattr(lm, "STEPS", 5)
    monkeypatch.setattr(lm, "BATCH", 4)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    net, table, workers = lm.classed_network(lm.id_rows(docs, PATH), PATH)
    rows = table.collect()
    windows = np.concatenate([np.frombuffer(r.windows, np.int32).reshape(-1, lm.WINDOW + 1) for r in rows])
    assert sorted(map(tuple, windows.tolist())) == sorted(map(tuple, whole.tolist()))
    lm.finish(net, *lm.cell_counts(net, stream))
    met = []
    gradients = lm._gradients
    monkeypatch.setattr(lm, "_gradients", lambda net, ids, target, real: (met.append(ids[:, :4].copy()), gradients(net, ids, target, real))[1])
    own = pa.table({"source": [0], "windows": [whole.tobytes()]})
    light = type("Light", (), {"value": net})
    assert lm._descend_worker(light, 0, 1)((pa.scalar(0),), own).num_rows == lm.PARTS
    assert {tuple(x) for x in np.concatenate(met).tolist()} == {tuple(x) for x in np.maximum(whole[:, :4], 0).tolist()}


def test_training_leaves_no_shuffle_files(spark, monkeypatch):
    """What rounds and counts shuffled is gone when the query is planned; stored ids are entropy-coded."""
    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}

    written = []
    store = lm.stored
    monkeypatch.setattr(lm, "STEPS", 5)
    monkeypatch.setattr(lm, "stored", lambda *args: (written.append(store(*args)), written[-1])[1])
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(i))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before, setting = shuffles(), spark.conf.get(DROP_SHUFFLES, None)
    scored = lm.score_documents(docs, PATH)
    until = time.time() + 20                                    # files are deleted beside the job
    while not shuffles() <= before and time.time() < until:
        time.sleep(0.1)
    assert shuffles() <= before
    assert spark.conf.get(DROP_SHUFFLES, None) == setting
    assert scored.count() == len(rows)
    files = [f for df in (written[0], written[-1]) for f in df.inputFiles()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_weights_are_the_same_in_blocks_of_any_size(network, monkeypatch):
    net, texts = network
    own = lm.training_windows(lm.Stream(pa.array(texts[:9]), codec(PATH)))
    whole, _ = lm.descend(net, own, 0, 3, 7)
    monkeypatch.setattr(lm, "ROWS_AT_ONCE", 3)
    blocks, _ = lm.descend(net, own, 0, 3, 7)
    assert all((whole[k] == blocks[k]).all() for k in whole) and (whole["embed"] != net.p["embed"]).any()


def test_base_scores(spark, awkward, empty):
    rows = [(i, t or "") for i, t in texts_of(awkward)]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    words = lambda t: [*t.encode().lower().split(), b"\n"]
    count = {}
    for i, t in rows:
        for w in words(t) if not held[i] else ():
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    want = sorted(((i, held[i], len(words(t)), sum(count.get(w, 0) > 0 for w in words(t)), n,
                    round(sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in words(t)), 3)) for i, t in rows), key=repr)
    steps, lm.STEPS = lm.STEPS, 5
    try:
        got = lm.score_documents(awkward, PATH).collect()
        assert lm.score_documents(empty, PATH).count() == 0
    finally:
        lm.STEPS = steps
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got),
                  key=repr) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_score_is_that_of_a_plain_forward_pass(spark, monkeypatch):
    """Rows of one id, of null id and of no text, in chunks of a few rows: each scored id by id in plain Python."""
    texts = ["the cat sat on the mat, " * 9 + "and slept", "", "A cat!", "Dogs bark \u00a0 at cats <|endoftext|> twice", "the mat"]
    rows = [(i % 3 if i % 4 else None, t) for i, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    nets = []
    monkeypatch.setattr(lm, "STEPS", 10)
    monkeypatch.setattr(lm, "CHUNK", 60)
    train = lm.train_in_rounds
    monkeypatch.setattr(lm, "train_in_rounds", lambda net, *rest: (train(net, *rest), nets.append(net)))
    got = sorted(((r.doc_id, round(r.n_tokens), round(r.score, 2)) for r in lm.score_documents(docs, PATH).collect()), key=repr)
    net, bpe, want = nets[0], codec(PATH), []
    p = {k: v.astype(float).tolist() for k, v in net.p.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    by = lambda a, m: [dot(a, col) for col in zip(*m)]
    for i, text in rows:
        ids = [bpe.special["<|startoftext|>"], *bpe.encode(text).tolist(), bpe.special["<|endoftext|>"]]
        n, done, begin, total = len(ids) - 1, 0, 0, 0.0
        while done < n:
            part = ids[begin:begin + lm.WINDOW + 1]
            x = [[a + b for a, b in zip(p["embed"][net.slot[w]], p["place"][t])] for t, w in enumerate(part[:-1])]
            q, k, v = ([by(a, p[name]) for a in x] for name in "qkv")
            for t in range(done - begin, len(part) - 1):
                a = [math.exp(dot(q[t], k[u]) / lm.WIDTH ** 0.5) for u in range(t + 1)]
                z = [dot(a, col) / sum(a) for col in zip(*v[:t + 1])]
                h = [b + c + d for b, c, d in zip(by(x[t], p["own"]), by(z, p["seen"]), p["hidden"])]
                logits = [b + c + d for b, c, d in zip(by([w / (1 + abs(w)) for w in h], p["out"]), p["bias"],
                                                       net.prior[net.cls[part[t]]].tolist())]
                total += logits[net.cls[part[t + 1]]] - math.log(sum(map(math.exp, logits)))
                total += float(net.log_in_class(np.array([part[t]]), np.array([part[t + 1]]))[0])
            done = begin + len(part) - 1
            begin += lm.WINDOW - lm.CONTEXT
        want.append((i, len(text.encode().split()) + 1, round(total / math.log(10), 2)))
    assert len(got) == len(rows)
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=0.02)


def test_lines_are_encoded_like_texts():
    bpe = codec(PATH)
    lines = ["Stra\u00dfe", "", "a\u00a0b", "\u00a0", "<|endoftext|>x", "\u0391\u03a3", "e\u0301t\u00e9,", "it's", "a\x1cb", "\u2028"]
    assert bpe.encode_lines("\n".join(lines)) == bpe.encode_many(lines)


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    from test_dedup import _jaccard, _lines
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, SMALL)
    scores = {r.doc_id: r.predicted for r in
              tox.score_documents(docs, tox.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))).collect()}
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, p in scores.items() if not p)
    lines = stage["line_dedup"](spark, docs, SMALL)
    assert lines.columns == docs.columns and dict(lines.dtypes) == dict(docs.dtypes)
    texts = {i: t for i, t, _, _ in _lines(texts_of(docs))}
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == {i: (t, len(t)) for i, t in texts.items()}
    near = stage["ngram_join"](spark, docs, SMALL)
    assert near.columns == docs.columns
    assert {r.doc_id for r in near.collect()} == {i for i, _, c in _jaccard(texts_of(docs), 5, 80) if i == c}
    pieces = stage["packing"](spark, docs, SMALL)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
