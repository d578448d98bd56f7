"""Chat formatting by columnar byte assembly, and the way back.

A turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>\\n``.  Control strings inside roles and
texts are escaped reversibly: a backslash goes in after their first character, one more where there
are backslashes already, so no control string is left and taking one backslash out gives the text.

Rows are dealt by conversation and sorted by turn.  For each Arrow batch the lengths of all segments
(header, text, end mark) give cumulative offsets; numpy scatter indices copy headers and contents
into one preallocated buffer that becomes the Arrow column of formatted texts.  A conversation that
goes on in the next batch continues there as its next ``part``: memory holds one batch however long
a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import bound_batches

# The template's own marks, and marks of other public templates that texts may hold.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = [START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>",
           "<|startoftext|>"]
LEARNED_ROLE = "assistant"

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = rf"([<\[])(\\*)({_TAILS})"
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_TAILS})")
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}\n", re.DOTALL)

FORMATTED = "part long, formatted string, loss_spans array<struct<start: long, length: long>>"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=_PLAIN, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_chat(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """conv_id, part, formatted, loss_spans: the spans of learned text, in code points of ``formatted``.

    Turns go in the order of (turn, role, text), null turns first; a null role or text is empty;
    repeated rows are turns of their own; rows of a null conv_id form one conversation.  Parts of a
    conversation, joined in order, are its whole text.  An empty table gives no rows; further columns
    are not read.
    """
    bound_batches(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()
    picked = rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_format_batches, f"conv_id {kind}, {FORMATTED}"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """Digest columns of each conversation, parsed from the output of ``format_chat`` alone:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
            .mapInArrow(_read_batches, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                       "loss_sha256 string, formatted_chars long"))


def assemble(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Join the byte segments of each row: (buffer, offsets of the rows in it)."""
    parts = [_bytes_of(c) for c in columns]
    lengths = np.stack([np.diff(offsets) for _, offsets in parts], axis=1)
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(lengths.shape)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k, (data, offsets) in enumerate(parts):
        source = np.arange(offsets[0], offsets[-1])
        out[source + np.repeat(starts[:, k] - offsets[:-1], lengths[:, k])] = data[source]
    return out, np.concatenate([[0], ends[len(columns) - 1::len(columns)]]).astype(np.int64)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def _format_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, part = object(), 0
    for b in batches:
        if not b.num_rows:
            continue
        ids, n = b.column("conv_id").to_pylist(), b.num_rows
        roles = b.column("role").dictionary_encode()
        heads = pa.array([f"{START}{r}{SEP}" for r in escape(roles.dictionary).to_pylist()], pa.string())
        columns = [heads.take(roles.indices), escape(b.column("text")), pa.array([f"{END}\n"] * n)]
        buffer, offsets = assemble(columns)
        first = np.array([i for i in range(n) if i == 0 or ids[i] != ids[i - 1]] + [n])  # rows that open a part
        texts = pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets[first]), pa.py_buffer(buffer))
        parts = np.zeros(len(first) - 1, np.int64)
        parts[0] = part + 1 if ids[0] == last else 0
        last, part = ids[-1], int(parts[-1])

        chars = np.stack([pc.utf8_length(c).to_numpy(zero_copy_only=False) for c in columns], axis=1)
        ends = np.cumsum(chars.sum(axis=1))
        at = np.concatenate([[0], ends])                        # code points before each row, in the batch
        begins = at[:-1] - np.repeat(at[first[:-1]], np.diff(first)) + chars[:, 0]
        learned = np.array([r == LEARNED_ROLE for r in b.column("role").to_pylist()])
        spans = pa.StructArray.from_arrays([pa.array(begins[learned], pa.int64()),
                                            pa.array(chars[learned, 1], pa.int64())], names=["start", "length"])
        bounds = np.concatenate([[0], np.cumsum(learned)])[first]
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id").take(pa.array(first[:-1])), pa.array(parts), texts.cast(pa.string()),
             pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)],
            names=["conv_id", "part", "formatted", "loss_spans"])


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> None:
        self.formatted_chars += len(formatted)
        for m in _TURN.finditer(formatted):
            self.n_turns += 1
            self.turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
        for s in spans:
            text = unescape(formatted[s["start"]:s["start"] + s["length"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars)


def _read_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now, kind = None, pa.int64()

    def out(digests: list[_Digest]) -> pa.RecordBatch:
        columns = list(zip(*(d.row() for d in digests)))
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for b in batches:
        kind, done = b.column("conv_id").type, []
        for conv_id, formatted, spans in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
            if now is None or now.conv_id != conv_id:
                done += [now] if now else []
                now = _Digest(conv_id)
            now.add(formatted, spans)
        if done:
            yield out(done)
    if now:
        yield out([now])
