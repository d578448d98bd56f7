"""License scans against regular expressions and word by word."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from pricewh.llm import license_scan as L
from pricewh.llm import words
from pricewh.llm.license_templates import BASE_PHRASES, TEMPLATES
from pricewh.llm.queries import QUERIES, template_pattern

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _words(text):
    return WORD.findall((text or "").translate(AZ))


def brute_places(ws, markup):
    """{last word: longest match's first word}, from a regular expression over every stretch of words."""
    found = {}
    pattern = re.compile(template_pattern(markup))
    for first, last in itertools.combinations(range(len(ws) + 1), 2):
        if pattern.fullmatch("".join(w + " " for w in ws[first:last])):
            found[last - 1] = min(first, found.get(last - 1, first))
    return found


def _found(text, rules):
    scanner = L.Scanner([L.parse_template(t) for t in rules])
    *places, (_, n, _) = scanner.places(text.encode())
    return places, n


MARKUP = ["a <<beginOptional>>b<<endOptional>> c", "a <<var;words=0..2>> a", "<<var;any=a b|c>> d <<beginOptional>>a "
          "<<beginOptional>>b<<endOptional>><<endOptional>> c", "b <<var;words=2..3>> <<var;any=c|d d>>", "a b", "c"]


@pytest.mark.parametrize("seed", range(6))
def test_automaton_against_regular_expressions(seed, monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", [1 << 20, 3, 7][seed % 3])
    monkeypatch.setattr(L, "MOST_STATES", [50_000, 3][seed % 2])
    rng = random.Random(seed)
    for _ in range(12):
        ws = rng.choices("abcdx", k=rng.randint(0, 14))
        places, n = _found("., ".join(ws).upper(), MARKUP)
        assert n == len(ws)
        for k, markup in enumerate(MARKUP):
            assert {(last, first) for t, first, last in places if t == k} == set(brute_places(ws, markup).items()), (ws, markup)


def _example(markup):
    """A text that a template accepts, with its optional regions."""
    text = re.sub(r"<<var;any=(.*?)(?:\|.*?)?>>", r"\1", markup)
    text = re.sub(r"<<var;words=(\d+)\.\.(\d+)>>", lambda m: " ".join(["Xeno"] * max(1, int(m[1]))), text)
    return re.sub(r"<<.*?>>", " ", text)


@pytest.mark.parametrize("label,strength,markup", TEMPLATES)
def test_mandatory_wording_has_to_be_exact(label, strength, markup):
    parts = L.parse_template(markup)
    text = _example(markup)
    ends = [p for p in _found(f"before it {text} after", [markup])[0] if p[0] == 0]
    assert ends and min(p[1] for p in ends) == 2
    mandatory = [p[1].decode() for p in parts if p[0] == "word"]
    assert mandatory
    for w in {mandatory[0], mandatory[len(mandatory) // 2], mandatory[-1]}:
        broken = re.sub(rf"(?i)(?<![a-z0-9]){w}(?![a-z0-9])", "zebra", text)
        assert not _found(broken, [markup])[0], w


def test_faulty_markup_is_refused():
    for markup in ("a <<beginOptional>>b", "a <<endOptional>>", "<<beginOptional>>a<<endOptional>>", "a <<what>> b", ""):
        with pytest.raises(ValueError):
            L.parse_template(markup)


def test_scan_tables(spark, awkward, empty):
    rows = [(20, "Released under the MIT License."), (21, "MIT  license, mit LICENSE\nApache license"), (22, "smit license"),
            (23, "The GNU General\n\tPublic-License, version 3; all rights reserved"), (23, "mit. license"),
            (24, "x " * 300_000 + "under the Apache License, Version 2.0. " + "y " * 300_000),
            (25, "This work is licensed under the GNU General Public License, version 3."), (None, "Licensed under CC BY-NC 4.0.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    docs = docs.withColumns({c: F.lit(3) for c in ("n_words", "found", "label", "score")})
    got = sorted(((r.doc_id, r.n_words, sorted((f.label, f.base, f.places, f.first_word, f.last_word) for f in r.found))
                  for r in L.scan_licenses(docs.repartition(4)).collect()), key=repr)
    want = []
    for r in docs.collect():
        ws, found = _words(r.text), []
        spots = sorted(i for w in ("license", "licensed", "reserved", "apache") for i, x in enumerate(ws) if x == w)
        near = ws[max(0, spots[0] - 12):spots[-1] + 12] if spots and spots[-1] - spots[0] < 40 else []
        shift = max(0, spots[0] - 12) if spots else 0
        for label, base, markup in [(a, True, t) for a, t in BASE_PHRASES] + [(a, False, t) for a, _, t in TEMPLATES]:
            places = brute_places(near, markup) if near else {}
            if places:
                found.append((label, base, len(places), min(places.values()) + shift, max(places.values()) + shift))
        want.append((r.doc_id, len(ws), sorted(found)))
    assert got == sorted(want, key=repr)
    assert L.scan_licenses(empty).count() == 0


def test_query_columns_of_rows_without_a_license(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, "nothing here"), (3, "mit license mit license")], "doc_id long, text string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_license_scan"](spark, str(tmp_path)).collect()}
    assert rows == {1: (0, 0, None, None, "", "", 0.0), 2: (2, 0, None, None, "", "", 0.0), 3: (4, 2, 0, 2, "mit", "mit", 0.5)}
