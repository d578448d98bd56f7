"""Near-duplicate embeddings by a tiled comparison in PCA order.

Vectors are scaled to length 1 and turned into the axes of their principal components, largest first,
which keeps all cosines.  Sorted by label and leading coordinate they are cut into blocks.  Blocks of
one label are compared in pairs ("tiles") unless the boxes around their leading coordinates are
farther apart than two linked vectors can be.  In a tile products of leading coordinates are added up
a few dimensions at a time; what the rest can still add is at most the product of the two suffix
norms (Cauchy-Schwarz), and a pair whose sum and bound stay below the threshold is given up.  A tile
ends as soon as no pair is left.  Turned vectors carry rounding: pairs whose sum comes within ``ROUNDING``
of the threshold are decided by the cosine of the vectors as given, which travel along.

A tile returns for each of its linked vectors the number of links and one other vector of its
connected part, not the pairs, so a large group of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import bound_batches, stored
from pricewh.llm.components import components

THRESHOLD = 0.93
#: Vectors of a block, dimensions added at a time, and dimensions of a block's box.
BLOCK, STEP, BOX = 1024, 8, 6
#: Room for rounding when a pair is given up before its whole cosine is known.
ROUNDING = 1e-9


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row: vec_id, n_links, component_id (smallest id reachable), kept.

    Vectors link when their labels are equal and not null, their lengths agree and their cosine is at
    least ``threshold``.  Null and zero vectors and those with a null or non-finite component link with
    nothing.  Rows that repeat an id are one vector (the least of them by label and components).  A
    row without id links with nothing, has a null component and is kept.  An empty table gives no rows;
    further columns are not read.
    """
    bound_batches(vectors.sparkSession)
    picked = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                            F.col(vector_col).cast("array<double>").alias("x"), F.col(label_col).alias("label"))
    one = (picked.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r"))
           .select("vec_id", "r.label", "r.x").filter("label IS NOT NULL AND x IS NOT NULL"))
    size = (one.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect())
    axes = principal_axes(one, int(size[0]["size"])) if size else np.zeros((0, 0))
    label_type = picked.schema["label"].dataType.simpleString()
    rotated = one.mapInArrow(_rotate(axes), f"vec_id long, label {label_type}, size int, lead double, y binary, x binary")
    blocks = stored(rotated.repartitionByRange("label", "size", "lead", "vec_id")
                    .sortWithinPartitions("label", "size", "lead", "vec_id")
                    .mapInArrow(_cut, _block_schema(label_type)), "vector-blocks")
    found = stored(tiles(blocks, threshold).mapInArrow(_compare(threshold), "vec_id long, n long, other long"),
                   "vector-links")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    parts = components(found.select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    known = (counts.join(parts, F.col("vec_id") == F.col("v"))
             .select(F.col("vec_id").alias("_id"), "n_links", "component"))
    joined = picked.select("vec_id").join(known, F.col("vec_id") == F.col("_id"), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def principal_axes(one: DataFrame, size: int) -> np.ndarray:
    """Axes of all vectors of the commonest length, largest second moment first; size * size sums come here."""
    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            x = _unit([v for v in b.column("x").to_pylist() if len(v) == size])[0]
            total += x.T @ x if len(x) else 0.0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], names=["k", "m"])

    rows = one.select("x").mapInArrow(moments, "k long, m double").groupBy("k").agg(F.sum("m").alias("m")).collect()
    total = np.zeros(size * size)
    for r in rows:
        total[r.k] = r.m
    return np.linalg.eigh(total.reshape(size, size))[1][:, ::-1]


def tiles(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs of blocks of one label and length whose boxes are near enough, with their vectors."""
    boxes = [f"{e}{d}" for e in ("lo", "hi") for d in range(BOX)]
    outline = blocks.select("label", "size", "block", *boxes)
    a, b = (outline.select("label", "size", *[F.col(c).alias(f"{s}_{c}") for c in ("block", *boxes)]) for s in "ab")
    gap = [F.greatest(F.lit(0.0), F.col(f"a_lo{d}") - F.col(f"b_hi{d}"), F.col(f"b_lo{d}") - F.col(f"a_hi{d}"))
           for d in range(BOX)]
    apart = sum((g * g for g in gap[1:]), gap[0] * gap[0])
    near = (a.join(b, ["label", "size"])
            .filter((F.col("a_block") <= F.col("b_block")) & (apart <= 2 - 2 * threshold + ROUNDING))
            .select("size", "a_block", "b_block"))
    for s in "ab":
        near = near.join(blocks.select(F.col("block").alias(f"{s}_block"), F.col("ids").alias(f"{s}_ids"),
                                       F.col("y").alias(f"{s}_y"), F.col("x").alias(f"{s}_x")), f"{s}_block")
    return near.select("size", (F.col("a_block") == F.col("b_block")).alias("same"),
                       *[f"{s}_{c}" for s in "ab" for c in ("ids", "y", "x")])


def _unit(vectors: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Valid vectors, scaled to length 1, and which ones are valid."""
    if not vectors:
        return np.zeros((0, 0)), np.zeros(0, bool)
    x = np.array([[np.nan if c is None else c for c in v] for v in vectors], float)
    with np.errstate(invalid="ignore", over="ignore"):
        x = x / np.maximum(np.abs(x).max(axis=1, initial=0.0), 1e-300)[:, None]     # no overflow in the norm
        norm = np.sqrt((x * x).sum(axis=1))
    valid = np.isfinite(norm) & (norm > 0)
    return x[valid] / norm[valid][:, None], valid


def _rotate(axes: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column("x").to_pylist()
            for size in sorted({len(v) for v in vectors}):
                at = np.array([i for i, v in enumerate(vectors) if len(v) == size])
                x, valid = _unit([vectors[i] for i in at])
                if not valid.any():
                    continue
                y = x @ axes if size == len(axes) else x
                rows = pa.array(at[valid])
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(rows), b.column("label").take(rows),
                     pa.array(np.full(len(rows), size, np.int32)), pa.array(np.ascontiguousarray(y[:, 0])),
                     pa.array([v.tobytes() for v in y], pa.binary()),
                     pa.array([_given(vectors[i]) for i in at[valid]], pa.binary())],
                    names=["vec_id", "label", "size", "lead", "y", "x"])
    return run


def _given(vector: list[float]) -> bytes:
    """The vector scaled by a power of two, which keeps its cosines to the last bit."""
    x = np.array(vector, np.float64)
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])).tobytes()


def _packed(x: np.ndarray) -> bytes:
    """In single precision if that loses nothing."""
    single = x.astype(np.float32)
    return (single if (single == x).all() else x).tobytes()


def _unpacked(data: np.ndarray, rows: int, size: int) -> np.ndarray:
    return data.view(np.float32 if len(data) == 4 * rows * size else np.float64).reshape(rows, size).astype(np.float64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with that of ``b`` in double precision, summed component by component."""
    dot, of_a, of_b = np.zeros((3, len(a)))
    for d in range(a.shape[1]):
        dot += a[:, d] * b[:, d]
        of_a += a[:, d] * a[:, d]
        of_b += b[:, d] * b[:, d]
    return dot / np.sqrt(of_a * of_b)


def _block_schema(label_type: str) -> str:
    return f"label {label_type}, size int, block long, ids binary, y binary, x binary, " + \
        ", ".join(f"{e}{d} double" for e in ("lo", "hi") for d in range(BOX))


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted vectors in blocks of one label and length."""
    number, held, key, label_type = TaskContext.get().partitionId() << 36, [], None, pa.null()

    def block() -> pa.RecordBatch:
        y = np.frombuffer(b"".join(v for _, v, _ in held)).reshape(len(held), -1)
        lead = np.zeros((len(held), BOX))
        lead[:, :min(BOX, y.shape[1])] = y[:, :BOX]
        columns = [pa.array([key[0]], label_type), pa.array([key[1]], pa.int32()), pa.array([number], pa.int64()),
                   pa.array([np.array([i for i, *_ in held], np.int64).tobytes()], pa.binary()),
                   pa.array([y.tobytes()], pa.binary()),
                   pa.array([_packed(np.frombuffer(b"".join(x for *_, x in held)))], pa.binary()),
                   *(pa.array([float(v)]) for v in lead.min(axis=0)), *(pa.array([float(v)]) for v in lead.max(axis=0))]
        return pa.RecordBatch.from_arrays(columns, names=["label", "size", "block", "ids", "y", "x", *(
            f"{e}{d}" for e in ("lo", "hi") for d in range(BOX))])

    for b in batches:
        label_type = b.column("label").type
        for label, size, *vector in zip(*(b.column(c).to_pylist() for c in ("label", "size", "vec_id", "y", "x"))):
            if held and (key != (label, size) or len(held) == BLOCK):
                yield block()
                number, held = number + 1, []
            key = (label, size)
            held.append(vector)
    if held:
        yield block()


def _compare(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in range(b.num_rows):
                size, same = b.column("size")[t].as_py(), b.column("same")[t].as_py()
                (ids_a, a, x_a), (ids_b, c, x_b) = ((np.frombuffer(b.column(f"{s}_ids")[t].as_buffer(), np.int64),
                                                     np.frombuffer(b.column(f"{s}_y")[t].as_buffer()).reshape(-1, size),
                                                     np.frombuffer(b.column(f"{s}_x")[t].as_buffer(), np.uint8))
                                                    for s in "ab")
                i, j = linked_pairs(a, c, threshold, same, (_unpacked(x_a, *a.shape), _unpacked(x_b, *c.shape)))
                if not len(i):
                    continue
                ids = np.concatenate([ids_a, ids_b]) if not same else ids_a
                j = j if same else j + len(ids_a)
                n = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
                other = smallest_connected(i, j, ids)
                hit = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(n[hit].astype(np.int64)),
                                                  pa.array(other[hit])], names=["vec_id", "n", "other"])
    return run


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool,
                 given: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` whose product is at least ``threshold``; of one block each pair once.  ``given``:
    the vectors behind ``a`` and ``b``, whose cosine decides where the product is too close to tell."""
    given = given or (a, b)
    size = a.shape[1]
    rest_a, rest_b = (np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]) for x in (a, b))
    total, alive, i, j = np.zeros((len(a), len(b))), None, None, None
    for d in range(0, size, STEP):
        e = min(d + STEP, size)
        if i is None:
            total += a[:, d:e] @ b[:, d:e].T
            if e < size:
                alive = total + np.outer(rest_a[:, e], rest_b[:, e]) >= threshold - ROUNDING
                if same:
                    alive = np.triu(alive, 1)
                left = int(np.count_nonzero(alive))
                if not left:
                    return np.zeros(0, np.int64), np.zeros(0, np.int64)
                if left * 16 < alive.size:              # few pairs: go on with them one by one
                    i, j = np.nonzero(alive)
                    total = total[i, j]
        else:
            total = total + np.einsum("ij,ij->i", a[i, d:e], b[j, d:e])
            if e < size:
                keep = total + rest_a[i, e] * rest_b[j, e] >= threshold - ROUNDING
                i, j, total = i[keep], j[keep], total[keep]
    if i is None:
        i, j = np.nonzero((np.triu(total, 1) if same else total) >= threshold - ROUNDING)
        total = total[i, j]
    keep = total >= threshold - ROUNDING
    close = np.flatnonzero(keep & (total <= threshold + ROUNDING))
    for k in range(0, len(close), BLOCK):
        some = close[k:k + BLOCK]
        keep[some] = cosines(given[0][i[some]], given[1][j[some]]) >= threshold
    return i[keep], j[keep]


def smallest_connected(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each vector the smallest id of those it is connected with by the pairs."""
    least = ids.copy()
    while True:
        before = least.copy()
        low = np.minimum(least[i], least[j])
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        if (before == least).all():
            return least
