"""Tokenising, URL rules, chat formatting and packing against libraries and plain Python."""

import hashlib
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from conftest_llm import SMALL, texts_of
from pricewh.llm import bpe, chat_format, packing, url_filter
from pricewh.llm.queries import URL_RULES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = ["", " \t\n", "it's I'LL 'sx 42", "ΑΣ ΣΑΣ.", "<|startoftext|>a<|endoftext|> <|x|>", "x\x1cy\x85z\u00a0w\u2003v",
             "e\u0301 \u0301a \u0130stanbul", "ab" * 900, "!?" * 300, "th" * 31 + "e", "\U0001f600\U0001f600 \u4f60\u597d", "a\x00b"]


def test_bpe_agrees_with_the_library():
    own = bpe.WordBPE(PATH)
    texts = ODD_TEXTS + [chr(c) + "a" + chr(c) + " " + chr(c) for c in range(0x20, 0x500)]
    for text, data in zip(texts, own.encode_many(texts)):
        ids = np.frombuffer(data, "<u4")
        assert ids.tolist() == _ids(text), text
        assert own.decode(ids) == LIBRARY.decode(_ids(text), skip_special_tokens=False)


def test_long_and_short_words_merge_alike(monkeypatch):
    words = ["".join(np.random.default_rng(k).choice(list("thearinsoé"), 40)) for k in range(60)]
    short = bpe.WordBPE(PATH).encode_many(words)
    monkeypatch.setattr(bpe, "SHORT", 2)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    own = bpe.WordBPE(PATH)
    assert [own.encode_many([w])[0] for w in words] == short


def test_every_code_point():
    """Letters, numbers, case, composition and white space of all of Unicode are those of the library."""
    own = bpe.WordBPE(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(points), 50_000):
        texts = [f"a{chr(c)}1b {chr(c)}{chr(c)}x" for c in points[i:i + 50_000]]
        theirs = LIBRARY.encode_batch(texts, add_special_tokens=False)
        assert [t for t, e, d in zip(texts, theirs, own.encode_many(texts)) if e.ids != np.frombuffer(d, "<u4").tolist()] == []


def test_pieces_of_the_older_generation_come_back(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own, texts = bpe.WordBPE(PATH), ["one, two <|endoftext|> three", "one, <|ENDOFTEXT|> four", "two five!? one,", "x y z", "one, two"]
    for text in texts * 3:
        assert own.encode(text).tolist() == _ids(text)
    assert len(own._pieces) + len(own._before) < 30


def test_round_trip_digests_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs, PATH).collect()}
    for doc_id, text in texts_of(docs):
        ids = _ids(text)
        assert got[doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_encode_and_decode_tables(awkward, empty):
    docs = awkward.sparkSession.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(40).unionByName(
        awkward.select("doc_id", "text"))
    rows = texts_of(docs)
    encoded = bpe.encode_documents(docs, PATH)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in encoded.collect()), key=repr) == sorted(
        ((i, tuple(_ids(t))) for i, t in rows), key=repr)
    decoded = {(r.doc_id, r.text) for r in bpe.decode_documents(encoded, PATH).collect()}
    assert decoded == {(i, LIBRARY.decode(_ids(t), skip_special_tokens=False)) for i, t in rows}
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.round_trip(awkward, PATH).collect()}
    assert digests == {(i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest())
                       for i, t in texts_of(awkward) for x in [_ids(t)]}
    assert bpe.round_trip(empty, PATH).count() == 0


def _judge(url, rules):
    rest = (url or "").partition("://")[2]
    host = rest.split("/")[0].split("?")[0].split("#")[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = host.encode().lower().decode()
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_url_rules(spark):
    hosts = ["com", "example.com", "EXAMPLE.com", "www.example.com", "a.www.example.com", "xexample.com", "net", "a.net",
             "com.net", ".com", "example.com.", "example.com:80", "", "é.net", "a..com", "communication.org"]
    tails = ["", "/", "/en/", "/en/x?y=/z", "/EN/", "/es/#t", "/fr", "/fr/", "?/en/", "#/", "//en/", "/en/\n/x"]
    urls = [f"{s}{h}{t}" for s in ("http://", "a://b://", "") for h in hosts for t in tails] + [None, "", "://", "x://"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://a.net/es/"), (0, urls[0])]
    rules = URL_RULES + [("b:", "/", "block"), ("net", "/", "allow"), ("a.net", "/e", "block"), ("", "/", "block")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    df = df.select("*", df.url.alias("host"), df.url.alias("_key"))
    got = sorted(map(tuple, url_filter.filter_urls(df, rules).collect()), key=repr)
    assert got == sorted(((i, *_judge(u, rules)) for i, u in rows), key=repr)
    assert url_filter.filter_urls(df.filter("false"), rules).count() == 0


def _talks(spark):
    control = chat_format.CONTROL
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
            (1, 2, "assistant", None), (1, 1, None, "Ünï\n"), (1, None, "system", ""), (1, 1, "user", "b"), (1, 1, "user", "b"),
            (None, 0, "assistant", "no id"), (3, 0, "assistant", "".join(control)),
            (3, 1, "<|im_sep|>", "<\\|im_end|><\\\\/s>[\\INST]"), (4, 0, "assistant", "x" * 300_000)]
    rows += [(5, i, "assistant" if i % 2 else "user", f"turn {i} {control[i % len(control)]}") for i in range(6000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return rows, df.select("*", df.turn.alias("part"), df.text.alias("formatted"))


def test_chat_round_trip(spark):
    rows, df = _talks(spark)
    formatted = chat_format.format_chat(df)
    parts = formatted.filter("conv_id = 5").count()
    assert parts > 1                                        # a long conversation goes on in further parts
    got = {r.conv_id: r for r in chat_format.read_chat(formatted).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    texts = {r.conv_id: r.formatted for r in formatted.filter("conv_id < 5").collect()}
    assert all(texts[k].count(c) == (0 if c not in (chat_format.START, chat_format.SEP, chat_format.END) else got[k].n_turns)
               for k in texts for c in chat_format.CONTROL)
    assert all(len(texts[k]) == got[k].formatted_chars for k in texts)
    assert chat_format.read_chat(chat_format.format_chat(df.filter("false"))).count() == 0


def _least_cost(places, prices, size):
    best = {0: 0}
    for at, price in zip(places[1:], prices[1:]):
        costs = []
        for p, c in best.items():
            n = at - p
            if n <= size:
                free = n >= packing.LEAST_POWER and n & (n - 1) == 0
                costs.append(c + (0 if free else size - n) + price + packing.WINDOW)
        best[at] = min(costs)
    return best[places[-1]]


@pytest.mark.parametrize("seed", range(20))
def test_windows_cost_the_least(seed):
    rng = np.random.default_rng(seed)
    places = np.concatenate([[0], np.cumsum(rng.integers(1, 200, 60))]).tolist()
    prices = [0, *rng.choice([0, 8, 48], 60).tolist()]
    size = 512
    ends = packing.cut_windows(places, prices, size)
    assert ends[-1] == places[-1] and set(ends) <= set(places)
    cost, price = 0, dict(zip(places, prices))
    for a, b in zip([0, *ends], ends):
        n = b - a
        assert 0 < n <= size
        cost += (0 if n >= packing.LEAST_POWER and n & (n - 1) == 0 else size - n) + price[b] + packing.WINDOW
    assert cost == _least_cost(places, prices, size)


def test_packing_holds_each_token_once(awkward, empty, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 5000)
    docs = awkward.sparkSession.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        awkward.filter("doc_id IS NOT NULL").selectExpr("doc_id + 100000 AS doc_id", "text"))
    rows = {}
    for i, t in texts_of(docs):
        rows.setdefault(i, []).append(np.array([*_ids(t), packing.END_ID], "<u4"))
    pieces = packing.pack(docs, PATH).collect()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert len(ids) == p.length and any(
            p.doc_tokens == len(x) and (x[p.start:p.start + p.length] == ids).all() for x in rows[p.doc_id])
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        at = 0
        for p in own:
            assert p.offset == at
            at += p.length
        assert at <= packing.SIZE
    for i, copies in rows.items():
        assert sum(p.length for p in pieces if p.doc_id == i) == sum(map(len, copies))
    lengths = [sum(p.length for p in own) for own in sequences.values()]
    padded = sum(n if n & (n - 1) == 0 else packing.SIZE for n in lengths)
    assert sum(lengths) / padded > 0.9
    assert packing.pack(empty, PATH).count() == 0
    assert packing.pack(awkward.filter("doc_id IS NULL"), PATH).filter("doc_id IS NULL").count() >= 2
    assert zlib.crc32(b"") == 0
