"""URL rules by a sort-merge range join.

A rule is (host, path prefix, verdict).  It fits its host and all subdomains.  The canonical key
of a host is its labels reversed, each with a dot behind it (``a.example.com`` ->
``com.example.a.``), so "this host and all below it" is the interval of keys that start with the
rule's own key.  Urls are sorted by key inside each partition; one sweep over them and the sorted
rules keeps a stack of the rules whose interval holds the present key.  Intervals of keys are
nested or disjoint, which makes a stack enough.  No shuffle: each partition is swept on its own
against the rule list, so a hot host costs no more than any other.  The rule list is
configuration: it lives on the driver and goes to the tasks with the function.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import bound_batches, lower_az

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_az(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """One row for each page: page_id, host, path, rule (host + path, or null), verdict.

    The rule whose host + path is longest wins; of rules with equal host and path the first given.
    A url that no rule fits, a null url and one without ``://`` get ``default`` and a null rule.
    Repeated rows are judged one by one; an empty table gives no rows; further columns are not read.
    """
    bound_batches(pages.sparkSession)
    url = F.coalesce(F.col(url_col), F.lit(""))
    keyed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                         path_of(url).alias("path"))
    key = F.concat(F.array_join(F.reverse(F.split("host", "[.]", -1)), "."), F.lit("."))
    schema = keyed.schema.add("rule", "string").add("verdict", "string")
    ordered = sorted_rules(rules)

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = RuleStack(ordered)
        for b in batches:
            verdicts = [stack.judge(k, p) for k, p in zip(b.column("_key").to_pylist(), b.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("host"), b.column("path"),
                 pa.array([r for r, _ in verdicts], pa.string()),
                 pa.array([v or default for _, v in verdicts], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    return keyed.withColumn("_key", key).sortWithinPartitions("_key").mapInArrow(sweep, schema)


def sorted_rules(rules: Sequence[Rule]) -> list[tuple[str, list[tuple[str, str, str]]]]:
    """(interval's key, its rules with the longest path first), in key order."""
    keyed = sorted(((".".join(reversed(h.split("."))) + ".", p, f"{h}{p}", v) for h, p, v in rules),
                   key=lambda r: (r[0], -len(r[1])))
    return [(k, [r[1:] for r in group]) for k, group in groupby(keyed, key=lambda r: r[0])]


class RuleStack:
    """The sweep's state.  ``judge`` must see keys in ascending order."""

    def __init__(self, ordered: list[tuple[str, list[tuple[str, str, str]]]]):
        self.ordered, self.next, self.active = ordered, 0, []

    def judge(self, key: str, path: str) -> tuple[str | None, str | None]:
        while self.next < len(self.ordered) and self.ordered[self.next][0] <= key:
            start = self.ordered[self.next][0]
            while self.active and not start.startswith(self.active[-1][0]):
                self.active.pop()
            self.active.append(self.ordered[self.next])
            self.next += 1
        while self.active and not key.startswith(self.active[-1][0]):
            self.active.pop()
        best: tuple[str | None, str | None] = (None, None)
        for _, here in self.active:
            hit = next((r for r in here if path.startswith(r[0])), None)
            if hit and (best[0] is None or len(hit[1]) > len(best[0])):
                best = hit[1:]
        return best


def _rest(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
