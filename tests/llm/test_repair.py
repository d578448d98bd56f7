"""Conversation repair against an exhaustive search over edit scripts."""

import hashlib
import itertools
import random
import re
from functools import lru_cache

import pytest

from pricewh.llm import conversation_repair as C
from pricewh.llm import role_grammar as G
from pricewh.llm.queries import damaged

GOOD = re.compile(r"(s?(ua)+)?")


def _facts(rows):
    """(role, text, fault) by the rules, row by row."""
    out, seen = [], set()
    for _, role, text in rows:
        plain = re.sub(r"[ \t-\r]+$", "", text)
        fault = ("blank" if not plain else "duplicate" if (role, text) in seen
                 else "truncated" if plain[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows):
    """Cheapest (cost, audit, repaired) over all scripts with at most two turns inserted between rows."""
    facts, best = _facts(rows), None
    gaps = [("",), ("u",), ("a",), ("u", "a"), ("a", "u")]

    def walk(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for made in gaps:
            made = tuple(m for m in made if m)
            c, a = cost + 5 * len(made), audit + "I" * len(made)
            o = out + [({"u": "user", "a": "assistant"}[m], "") for m in made]
            if i == len(facts):
                if GOOD.fullmatch("".join(r[:1] if r else "?" for r, _ in o)) and (best is None or (c, a) < best[:2]):
                    best = (c, a, o)
                continue
            role, text, fault = facts[i]
            walk(i + 1, c + 2, a + "D", o)
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                walk(i + 1, c + extra, a + "K", o + [(role, text)])
                for r in ("user", "assistant"):
                    walk(i + 1, c + 1 + extra, a + "R", o + [(r, text)])

    walk(0, 0, "", [])
    return best


def expected(conv_id, rows):
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = [f for *_, f in _facts(rows)]
    cost, audit, repaired = brute(rows)
    turns = {t for t, *_ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{x}" for r, x in repaired)
    return (conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def _result(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                                               "audit", "repaired_sha256").collect()), key=repr)


@lru_cache
def _talks():
    rng, out = random.Random(5), {None: [(None, "user", "a."), (3, None, None), (3, "assistant", "b!")]}
    roles = ["user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["yes.", "no!", "cut off", "", " \t", None, "a.b", "fine? \n", "Ä."]
    for k in range(120):
        n = rng.randint(1, 5)
        out[k] = [(rng.choice([None, 0, 1, 2, 4, 9, 9]), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0],
                   rng.choices(texts, [6, 5, 3, 1, 1, 1, 2, 2, 2])[0]) for _ in range(n)]
    return out


@pytest.fixture(scope="module")
def talks(spark):
    from pyspark.sql import functions as F
    rows = [(c, *r) for c, rs in _talks().items() for r in rs]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit(7) for c in ("part", "seq", "id", "head", "audit", "cost", "dropped")})


@pytest.mark.parametrize("piece_rows", [512, 1, 2])
def test_repair_against_exhaustive_search(talks, piece_rows):
    got = _result(C.report(C.repair(talks, piece_rows=piece_rows)))
    assert got == sorted((expected(c, rows) for c, rows in _talks().items()), key=repr)


def test_one_conversation_over_many_pieces(spark):
    """A third of all rows in one conversation, with copies: pieces of any size give one answer."""
    rng = random.Random(11)
    rows = [(1, i // 3, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"t{i}.", f"u{i}."]))
            for i in range(600)] + [(1, None, "user", "same.")] * 200 + [(c, 0, "user", "x.") for c in range(2, 900)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    results = [_result(C.report(C.repair(frame, piece_rows=n))) for n in (10_000, 7, 64)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 899
    hot = next(r for r in results[0] if r[0] == 1)
    assert sum(hot[7].count(e) for e in "KRD") == 800
    assert hot[3] >= 199


def test_long_ways_meet_again(monkeypatch):
    """Ways of equal cost are told apart by their audits from where they part."""
    root = C._Path(None, 0, "")
    a = C._Path(C._Path(root, 0, "KK"), 0, "D")
    b = C._Path(C._Path(a.before, 0, "DD"), 0, "K")
    assert C._apart(a, b) == ("D", "DDK")
    assert C._cheaper((4, a, "K"), (4, b, "")) is False and C._cheaper((3, a, "K"), (4, b, "")) is True


def test_grammar_automaton_accepts_the_language():
    for n in range(7):
        for word in itertools.product("sua", repeat=n):
            node = G.FIRST
            for symbol in word:
                node = None if node is None else G.SHIFTS[node].get(symbol)
            assert (node is not None and G.ACCEPTED[node]) == bool(GOOD.fullmatch("".join(word))), word
    assert max(len(s) for s in G.SHIFTS) <= 2 and set(G.ENDINGS) == set(range(len(G.SHIFTS)))


def test_dropped_rows_and_damage(spark):
    import zlib
    rows = [(c, t, r, x) for c in [*range(40), None] for t, r, x in
            [(0, "system", "Be kind."), (1, "user", "Why? So."), (2, "assistant", "Because."), (None, None, None)]]
    out = {}
    for c, t, r, x in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        out.setdefault(c, [])
        out[c] += [(t, "user" if fault == 4 else r, x)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = _result(C.report(C.repair(damaged(frame), "dropped")))
    assert got == sorted((expected(c, rs) for c, rs in out.items()), key=repr)


def test_no_rows_left_and_no_rows_at_all(spark):
    frame = spark.createDataFrame([(5, 1, "user", "x.", True), (5, None, None, None, True)],
                                  "conv_id long, turn long, role string, text string, gone boolean")
    assert _result(C.report(C.repair(frame, "gone"))) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert C.report(C.repair(frame.filter("false"), "gone")).count() == 0


def test_very_long_texts(spark):
    long = "many words of one turn " * 60_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (1, 2, "user", long + "?"), (1, 3, "assistant", "ok.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _result(C.report(C.repair(frame))) == [expected(1, [r[1:] for r in rows])]
