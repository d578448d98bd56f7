"""Conversation structure repair by generalised LR parsing (``role_grammar``), in pieces.

Rows are dealt by ranges of (conversation, turn, role, text) and cut into pieces of at most
``piece_rows`` rows and ``PIECE_BYTES`` of text, so a conversation with a share of all rows spreads over
many tasks.  Most conversations lie whole inside one piece and are repaired there.  For the pieces of
the others, each is parsed from every stack that the rows before it could leave; the summaries (a
cost and an audit from stack to stack, no texts) are chained in order, which settles the piece's edits,
and the edits go back to the piece's rows.  The only work that follows one conversation from end to
end is that chain and, in ``report``, the running digest of its repaired text.

Repetitions inside a conversation that is cut are found from the first place of each (role, digest of
text), aggregated before the shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm import role_grammar as G
from pricewh.llm.common import ASCII_SPACE, bound_batches, stored

PIECE_ROWS, PIECE_BYTES = 512, 4 << 20
#: Rows of one turn are ordered by role and text; beyond this many characters by a hash of the text.
ORDERED_CHARS = 1000
# The pairs of role initials that may follow each other, and what ends a whole text.
LEGAL_PAIRS = {"su", "ua", "au"}
SENTENCE_ENDS = ".!?"

_NOT_SPACE = re.compile(f"[^{ASCII_SPACE}]")
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("dropped", pa.bool_())])
_TURNS = "turns array<struct<turn: long, role: string, text: string, dropped: boolean>>"
_REPAIRED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def repair(rows: DataFrame, dropped_col: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Pieces of repaired conversations: conv_id, part, seq (their order), audit, repaired
    array<struct<role, text>>, the counts blank, duplicate, truncated, illegal and cost, and the first
    and last turns and role initials, which ``report`` needs to join pieces.

    Rows (conv_id, turn, role, text) go by turn, null turns first, then role and text.  A null role or
    text is one space; rows of a null conv_id form one conversation; repeated rows are duplicates.  A row
    whose ``dropped_col`` is true is absent, but its conversation still has a result.  An empty table
    gives no rows; further columns are not read.
    """
    if piece_rows < 1:
        raise ValueError("piece_rows must be at least 1")
    bound_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "head", "tie", "id"]
    ranged = (rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                          F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                          (F.coalesce(F.col(dropped_col), F.lit(False)) if dropped_col else F.lit(False)).alias("dropped"))
              .withColumns({"head": F.substring("text", 1, ORDERED_CHARS), "tie": F.xxhash64("text"),
                            "id": F.monotonically_increasing_id()})
              .repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv_id", "turn", "role", "text", "dropped"))
    pieces = stored(ranged.mapInArrow(_cut(piece_rows), f"conv_id {kind}, part int, seq long, whole boolean, {_TURNS}"),
                    "repair-pieces")
    out = (f"conv_id {kind}, part int, seq long, n_rows long, " + "".join(f"{c} long, " for c in _COUNTS) +
           "first_turn long, last_turn long, n_turns long, first_initial string, last_initial string, audit string, "
           "repaired array<struct<role: string, text: string>>")
    whole = pieces.filter("whole").mapInArrow(_repair_whole, out)

    rest = pieces.filter("NOT whole").drop("whole")
    places = rest.select("conv_id", "part", "seq", F.posexplode("turns").alias("i", "t")).filter("NOT t.dropped")
    firsts = (places.groupBy("conv_id", "t.role", F.sha2("t.text", 256).alias("digest"))
              .agg(F.min(F.struct("part", "seq", "i")).alias("at")).select("at.*")
              .groupBy("part", "seq").agg(F.collect_list("i").alias("firsts")))          # at most piece_rows
    rest = stored(rest.join(firsts, ["part", "seq"], "left"), "repair-cut")
    moves = rest.mapInArrow(_summarise, f"conv_id {kind}, part int, seq long, "
                                        "moves array<struct<entry: int, leave: int, cost: long, audit: string>>")
    chosen = (moves.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
              .mapInArrow(_choose, "part int, seq long, entry int, audit string"))
    cut = rest.join(chosen, ["part", "seq"]).select(*rest.columns, "entry", "audit").mapInArrow(_apply, out)
    return whole.unionByName(cut)


def report(pieces: DataFrame) -> DataFrame:
    """One row a conversation from the output of ``repair``: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    return (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_report, f"conv_id {kind}, gaps long, " + "".join(f"{c} long, " for c in _COUNTS) +
                        "audit string, repaired_sha256 string"))


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _cut(piece_rows: int):
    """Sorted rows to pieces.  A piece is whole if it is neither at an end of the partition nor cut."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        joined = True                                         # the piece in hand may go on what lies before it
        schema, conv_id = None, None

        def piece(whole: bool) -> pa.RecordBatch:
            return _batch([{"conv_id": conv_id, "part": part, "seq": seq, "whole": whole, "turns": held}], schema)

        for b in batches:
            schema = schema or pa.schema([("conv_id", b.schema.field("conv_id").type), ("part", pa.int32()),
                                          ("seq", pa.int64()), ("whole", pa.bool_()), ("turns", pa.list_(_TURN))])
            for r in b.to_pylist():
                same = bool(held) and r["conv_id"] == conv_id
                if held and (not same or len(held) >= piece_rows or size >= PIECE_BYTES):
                    yield piece(not joined and not same)
                    seq, held, size, joined = seq + 1, [], 0, same
                conv_id = r.pop("conv_id")
                held.append(r)
                size += len(r["text"])
        if held:
            yield piece(False)
    return run


def _facts(turns: list[dict], firsts: set[int] | None) -> list[tuple]:
    """(turn, role, text, fault) of the rows that are present; ``firsts``: places that repeat nothing."""
    out, seen = [], set()
    for i, t in enumerate(turns):
        if t["dropped"]:
            continue
        role, text = t["role"], t["text"]
        again = (role, text) in seen if firsts is None else i not in firsts
        seen.add((role, text)) if firsts is None else None
        fault = ("blank" if not _NOT_SPACE.search(text) else "duplicate" if again
                 else "truncated" if text.rstrip(ASCII_SPACE)[-1] not in SENTENCE_ENDS else None)
        out.append((t["turn"], role, text, fault))
    return out


def _parse(facts: list[tuple], frontier: G.Frontier) -> G.Frontier:
    for _, role, _, fault in facts:
        frontier = G.read_row(frontier, role[:1], fault in ("blank", "duplicate"), fault == "truncated")
    return frontier


def _row(piece: dict, facts: list[tuple], entry: int, audit: str) -> dict:
    """A piece's result under the given edits."""
    faults = [f for *_, f in facts]
    initials = [role[:1] for _, role, _, _ in facts]
    turns = [t for t, *_ in facts if t is not None]
    edits = [e for e in audit if e != "I"]
    cost = (G.INSERT * audit.count("I") + G.DELETE * audit.count("D") + G.REROLE * audit.count("R") +
            G.TRUNCATED * sum(f == "truncated" and e != "D" for f, e in zip(faults, edits)))
    return {"conv_id": piece["conv_id"], "part": piece["part"], "seq": piece["seq"], "n_rows": len(facts),
            **{c: faults.count(c) for c in _COUNTS[:3]}, "cost": cost,
            "illegal": sum(x + y not in LEGAL_PAIRS for x, y in zip(initials, initials[1:])),
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
            "n_turns": len(set(turns)), "first_initial": initials[0] if facts else None,
            "last_initial": initials[-1] if facts else None, "audit": audit,
            "repaired": [{"role": r, "text": t}
                         for r, t in G.apply_edits(entry, audit, [(role, text) for _, role, text, _ in facts])]}


def _result(kind: pa.DataType) -> pa.Schema:
    longs = ["n_rows", *_COUNTS, "first_turn", "last_turn", "n_turns"]
    return pa.schema([("conv_id", kind), ("part", pa.int32()), ("seq", pa.int64()), *[(c, pa.int64()) for c in longs],
                      ("first_initial", pa.string()), ("last_initial", pa.string()), ("audit", pa.string()),
                      ("repaired", _REPAIRED)])


def _best_end(frontier: G.Frontier) -> tuple[int, str]:
    return min((cost + G.ENDINGS[n][0], audit + G.ENDINGS[n][1]) for n, (cost, audit) in frontier.items()
               if n in G.ENDINGS)


def _repair_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for piece in b.to_pylist():
            facts = _facts(piece["turns"], None)
            rows.append(_row(piece, facts, G.FIRST, _best_end(_parse(facts, {G.FIRST: (0, "")}))[1]))
        if rows:
            yield _batch(rows, _result(b.schema.field("conv_id").type))


def _summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for piece in b.to_pylist():
            facts = _facts(piece["turns"], set(piece["firsts"] or []))
            moves = [{"entry": entry, "leave": leave, "cost": cost, "audit": audit}
                     for entry in range(len(G.SHIFTS))
                     for leave, (cost, audit) in _parse(facts, {entry: (0, "")}).items()]
            rows.append({"conv_id": piece["conv_id"], "part": piece["part"], "seq": piece["seq"], "moves": moves})
        if rows:
            move = pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
            yield _batch(rows, pa.schema([("conv_id", b.schema.field("conv_id").type), ("part", pa.int32()),
                                          ("seq", pa.int64()), ("moves", pa.list_(move))]))


class _Path:
    """A way through the pieces so far; ways share their beginnings."""
    __slots__ = ("before", "depth", "entry", "audit")

    def __init__(self, before: _Path | None, entry: int, audit: str):
        self.before, self.entry, self.audit = before, entry, audit
        self.depth = before.depth + 1 if before else 0


def _apart(a: _Path, b: _Path) -> tuple[str, str]:
    """What follows the common beginning of two ways."""
    xs, ys = [], []
    while a is not b:
        if a.depth >= b.depth:
            xs.append(a.audit)
            a = a.before
        else:
            ys.append(b.audit)
            b = b.before
    return "".join(reversed(xs)), "".join(reversed(ys))


def _cheaper(a: tuple[int, _Path, str], b: tuple[int, _Path, str] | None) -> bool:
    if b is None or a[0] != b[0]:
        return b is None or a[0] < b[0]
    x, y = _apart(a[1], b[1])
    return x + a[2] < y + b[2]


def _choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the summaries of each conversation and give every piece its entry stack and its audit."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("entry", pa.int32()), ("audit", pa.string())])
    conv_id, places, ways = None, [], {}

    def settled() -> pa.RecordBatch:
        best = None
        for node, (cost, path) in ways.items():
            if node in G.ENDINGS:
                end = (cost + G.ENDINGS[node][0], path, G.ENDINGS[node][1])
                best = end if _cheaper(end, best) else best
        _, path, tail = best
        audits, entries = [], []
        while path.before:
            audits.append(path.audit)
            entries.append(path.entry)
            path = path.before
        audits[0] += tail
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in places], pa.int32()), pa.array([s for _, s in places], pa.int64()),
             pa.array(entries[::-1], pa.int32()), pa.array(audits[::-1], pa.string())], schema=schema)

    for b in batches:
        for r in b.to_pylist():
            if places and r["conv_id"] != conv_id:
                yield settled()
                places = []
            if not places:
                conv_id, ways = r["conv_id"], {G.FIRST: (0, _Path(None, G.FIRST, ""))}
            best: dict[int, tuple] = {}
            for m in r["moves"]:
                if m["entry"] in ways:
                    cost, path = ways[m["entry"]]
                    step = (cost + m["cost"], path, m["audit"], m["entry"])
                    now = best.get(m["leave"])
                    if _cheaper(step[:3], now[:3] if now else None):
                        best[m["leave"]] = step
            ways = {leave: (cost, _Path(path, entry, audit)) for leave, (cost, path, audit, entry) in best.items()}
            places.append((r["part"], r["seq"]))
    if places:
        yield settled()


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [_row(p, _facts(p["turns"], set(p["firsts"] or [])), p["entry"], p["audit"]) for p in b.to_pylist()]
        if rows:
            yield _batch(rows, _result(b.schema.field("conv_id").type))


class _Report:
    def __init__(self, conv_id):
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.conv_id, self.audit, self.sha, self.empty = conv_id, [], hashlib.sha256(), True
        self.low = self.high = self.initial = None
        self.n_turns = 0

    def add(self, p: dict) -> None:
        for c in _COUNTS:
            self.counts[c] += p[c]
        if p["n_rows"]:
            if self.initial is not None:
                self.counts["illegal"] += self.initial + p["first_initial"] not in LEGAL_PAIRS
            self.initial = p["last_initial"]
        if p["n_turns"]:
            self.n_turns += p["n_turns"] - (self.high == p["first_turn"])
            self.low, self.high = p["first_turn"] if self.low is None else self.low, p["last_turn"]
        self.audit.append(p["audit"])
        for r in p["repaired"]:
            self.sha.update(f"{'' if self.empty else chr(10)}{r['role']}:{r['text']}".encode())
            self.empty = False

    def row(self) -> dict:
        gaps = self.high - self.low + 1 - self.n_turns if self.n_turns else 0
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "audit": "".join(self.audit),
                "repaired_sha256": self.sha.hexdigest()}


def _report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, kind = None, pa.int64()

    def out(done: list[_Report]) -> pa.RecordBatch:
        schema = pa.schema([("conv_id", kind), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS],
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])
        return _batch([d.row() for d in done], schema)

    for b in batches:
        kind, done = b.schema.field("conv_id").type, []
        for p in b.to_pylist():
            if now is None or now.conv_id != p["conv_id"]:
                done += [now] if now else []
                now = _Report(p["conv_id"])
            now.add(p)
        if done:
            yield out(done)
    if now:
        yield out([now])
