"""License scans by template-markup matching.

A template (markup: ``license_templates``) is parsed into words, optional regions and replaceable
regions and compiled into a nondeterministic automaton over word tokens.  All templates run at once
over the words of a text, from every word on, as one deterministic automaton whose states are built when
a text first reaches them.  A template is accepted where its mandatory wording stands exactly; at each
acceptance the reversed template is read backwards, which gives the word its longest match starts at.

Texts go through whole, one at a time and in slices; tasks keep the automaton (at most ``MOST_STATES``
states, then it starts again) and the last words of a slice that a match can reach back to.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import bound_batches
from pricewh.llm.license_templates import BASE_PHRASES, NAMED, TEMPLATES
from pricewh.llm.words import word_slices

MOST_STATES = 50_000
Part = tuple                                                 # ("word", w) ("optional", parts) ("any", [parts]) ("gap", a, b)
_FOUND = "found array<struct<label: string, base: boolean, strength: double, places: long, first_word: long, last_word: long>>"


def words_of(text: str) -> list[bytes]:
    return [w for s in word_slices(text.encode()) for w in s]


def parse_template(markup: str) -> list[Part]:
    """The parts of a template; regions nest."""
    open_regions: list[list[Part]] = [[]]
    for k, piece in enumerate(re.split(r"<<(.*?)>>", markup, flags=re.DOTALL)):
        if k % 2 == 0:
            open_regions[-1] += [("word", w) for w in words_of(piece)]
            continue
        kind, *fields = [f.strip() for f in piece.split(";")]
        named = dict(f.split("=", 1) for f in fields)
        if kind == "beginOptional":
            open_regions.append([])
        elif kind == "endOptional" and len(open_regions) > 1:
            region = open_regions.pop()
            open_regions[-1].append(("optional", region))
        elif kind == "var" and "any" in named:
            open_regions[-1].append(("any", [[("word", w) for w in words_of(x)] for x in named["any"].split("|")]))
        elif kind == "var" and "words" in named:
            low, high = map(int, named["words"].split(".."))
            open_regions[-1].append(("gap", low, high))
        else:
            raise ValueError(f"unknown markup <<{piece}>>")
    if len(open_regions) > 1:
        raise ValueError("an optional region is not closed")
    if not _least(open_regions[0]):
        raise ValueError("a template needs mandatory wording")
    return open_regions[0]


def _least(parts: list[Part]) -> int:
    return sum(1 if p[0] == "word" else p[1] if p[0] == "gap" else min(map(_least, p[1])) if p[0] == "any" else 0
               for p in parts)


def _most(parts: list[Part]) -> int:
    return sum(1 if p[0] == "word" else p[2] if p[0] == "gap" else max(map(_most, p[1])) if p[0] == "any" else _most(p[1])
               for p in parts)


def _reversed(parts: list[Part]) -> list[Part]:
    return [("optional", _reversed(p[1])) if p[0] == "optional" else ("any", [_reversed(x) for x in p[1]])
            if p[0] == "any" else p for p in reversed(parts)]


class Tokens:
    """Nondeterministic automaton over words: several templates, each with its own end."""

    def __init__(self, templates: list[list[Part]]):
        self.words: list[dict[bytes, list[int]]] = []
        self.anything: list[list[int]] = []
        self.free: list[list[int]] = []
        starts, self.end_of = [], {}
        for n, parts in enumerate(templates):
            starts.append(self._node())
            self.end_of[self._add(parts, starts[-1])] = n
        self.start = self.closed(starts)

    def _node(self) -> int:
        self.words.append({})
        self.anything.append([])
        self.free.append([])
        return len(self.words) - 1

    def _add(self, parts: list[Part], at: int) -> int:
        for p in parts:
            to = self._node()
            if p[0] == "word":
                self.words[at].setdefault(p[1], []).append(to)
            elif p[0] == "optional":
                self.free[at].append(to)
                self.free[self._add(p[1], at)].append(to)
            elif p[0] == "any":
                for x in p[1]:
                    self.free[self._add(x, at)].append(to)
            else:
                for k in range(p[2]):
                    if k >= p[1]:
                        self.free[at].append(to)
                    step = self._node()
                    self.anything[at].append(step)
                    at = step
                self.free[at].append(to)
            at = to
        return at

    def closed(self, nodes: Iterable[int]) -> frozenset[int]:
        found, todo = set(nodes), list(nodes)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in found:
                    found.add(to)
                    todo.append(to)
        return frozenset(found)

    def step(self, nodes: frozenset[int], word: bytes | None) -> frozenset[int]:
        """Nodes after a word; None stands for a word that leads on by no edge of its own."""
        return self.closed([t for n in nodes for t in (*self.anything[n], *self.words[n].get(word, ()))])

    def ends(self, nodes: frozenset[int]) -> list[int]:
        return sorted(self.end_of[n] for n in nodes if n in self.end_of)


class Scanner:
    """Finds all places of all templates in a stream of words."""

    def __init__(self, templates: list[list[Part]]):
        self.tokens = Tokens(templates)
        self.backwards = [Tokens([_reversed(t)]) for t in templates]
        self.reach = max(map(_most, templates))
        self._clear()

    def _clear(self) -> None:
        self.keys: dict[frozenset, frozenset] = {}
        self.states: dict[frozenset, tuple] = {}
        self.root = self._key(self.tokens.start)

    def _key(self, nodes: frozenset) -> frozenset:
        return self.keys.setdefault(nodes, nodes)

    def _state(self, key: frozenset) -> tuple[dict, frozenset, list[int]]:
        """(word -> state, state after any other word, templates that end here)."""
        if len(self.states) > MOST_STATES:
            self._clear()
            key = self._key(key)
        t = self.tokens
        known = {w for n in key for w in t.words[n]}
        state = ({w: self._key(t.step(key, w) | t.start) for w in known}, self._key(t.step(key, None) | t.start), t.ends(key))
        self.states[key] = state
        return state

    def places(self, text: bytes) -> Iterator[tuple[int | None, int, int]]:
        """(template, first word, last word) for each place; last (None, number of words, the same)."""
        here, at, tail = self.root, 0, []
        following, other, ends = self.states.get(here) or self._state(here)
        for words in word_slices(text):
            for i, w in enumerate(words):
                key = following.get(w, other)
                if key is not here:
                    here = key
                    following, other, ends = self.states.get(here) or self._state(here)
                for n in ends:
                    yield n, at + i + 1 - self._length(n, words, i, tail), at + i
            at += len(words)
            tail = (tail + words[-self.reach:])[-self.reach:]
        yield None, at, at

    def _length(self, template: int, words: list[bytes], last: int, tail: list[bytes]) -> int:
        """Words of the longest match of a template that ends at ``last``."""
        back = self.backwards[template]
        nodes, length = back.start, 0
        for k in range(self.reach):
            i = last - k
            if i < -len(tail) or not nodes:
                break
            nodes = back.step(nodes, words[i] if i >= 0 else tail[i])
            if back.ends(nodes):
                length = k + 1
        return length


@functools.lru_cache(4)
def _scanner(templates: tuple[str, ...]) -> Scanner:
    return Scanner([parse_template(t) for t in templates])


def scan_licenses(docs: DataFrame, templates: list[tuple[str, float, str]] = TEMPLATES,
                  phrases: list[tuple[str, str]] = BASE_PHRASES) -> DataFrame:
    """doc_id, n_words, found: for each phrase and template that stands in the text its label, whether it
    is a base phrase, strength, number of places (ends at which it is accepted), and the smallest and
    largest word, from 0, at which a place starts.

    Every row is a document of its own, with repeated or null ids too.  A null or empty text has no words
    and nothing found; an empty table gives no rows; further columns are not read.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rules = [(label, True, NAMED, text) for label, text in phrases] + [(la, False, s, t) for la, s, t in templates]
    _scanner(tuple(t for *_, t in rules))                     # faulty markup fails here, not in a task
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(_scan(rules), f"doc_id {kind}, n_words long, {_FOUND}")


def _scan(rules: list[tuple[str, bool, float, str]]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(tuple(t for *_, t in rules))
        entry = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("strength", pa.float64()),
                           ("places", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())])
        for b in batches:
            counts, found = [], []
            for text in b.column("text").to_pylist():
                held: dict[int, list[int]] = {}
                for template, first, _ in scanner.places(text):
                    if template is None:
                        n = first
                        continue
                    h = held.setdefault(template, [0, first, first])
                    h[0], h[1], h[2] = h[0] + 1, min(h[1], first), max(h[2], first)
                counts.append(n)
                found.append([{"label": rules[t][0], "base": rules[t][1], "strength": rules[t][2], "places": k,
                               "first_word": first, "last_word": last} for t, (k, first, last) in sorted(held.items())])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()),
                                              pa.array(found, pa.list_(entry))], names=["doc_id", "n_words", "found"])
    return run
