"""Jaccard self-join of documents on sets of word shingles, by PartEnum signatures.

1. Each text becomes its set of hashed shingles.  Documents with the same set are one class; its
   smallest id stands for it.
2. Signatures (``partenum``) of all sets go, as packed arrays, to buckets by signature.  A batch sends
   one of its equal sets.  A bucket sorts its signatures and keeps those of two documents or more.
   Where one batch alone has many documents of a signature, only the first goes to the bucket and all
   go past it, spread over tasks: no bucket gathers a frequent signature.
3. Groups of classes with a common signature are compared for connection, not in all pairs: first
   each member with a few leaders of its group; then what is still apart with each other.  Pairs must
   pass two filters which lose nothing: the sizes, and the parities of the features in 1024 cells (each
   differing feature changes one parity, so too many different parities exclude a pair).
4. Candidates are compared in full.  Components of the links are found by ``components``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import bound_batches, stored
from pricewh.llm.components import components
from pricewh.llm.partenum import Scheme
from pricewh.llm.shingles import mix, shingle_sets, slices

WIDTH, OF, OUT_OF = 5, 80, 100
#: Signatures that a bucket holds on average, and documents of a batch that make a signature frequent.
BUCKET, FREQUENT = 1_000_000, 32
PARITY_WORDS = 16
#: Leaders of a group that its members are compared with before all pairs that are left.
LEADERS = 2


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       of: int = OF, out_of: int = OUT_OF) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Two documents link when out_of * |A and B| >= of * |A or B|.  Ids are whole numbers.  A text of
    fewer than ``width`` words has its whole sequence as one shingle; a null text and one without words
    have none and link with nothing.  Rows that repeat an id are one document.  A row without id links
    with nothing and has no component.  An empty table gives no rows; further columns are not read.
    """
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stored(_sets(picked, width), "shingle-sets")
    most = sets.agg(F.max("n_shingles"), F.sum("n_shingles")).first()
    scheme = Scheme(of, out_of, most[0] or 1)
    filled = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("fingerprint").agg(F.min("doc_id").alias("v"))
    of_class = filled.join(classes, "fingerprint")
    nodes = stored(of_class.groupBy("doc_id").agg(F.min("v").alias("v"), F.first("n_shingles").alias("n"),
                                                  *[F.first(f"s{i}").alias(f"s{i}") for i in range(PARITY_WORDS)]),
                   "shingle-nodes")
    vertices = nodes.filter("doc_id = v").drop("doc_id")

    members = _members(picked, width, scheme, 1 + int(most[1] or 0) * 2 // (3 * BUCKET))
    members = members.join(nodes.select("doc_id", "v"), "doc_id").select("sig", "v").distinct()
    members = stored(_different_groups(stored(members, "signature-rows")), "signature-groups")

    leaders = members.groupBy("sig").agg(F.array(*[F.min_by("v", F.xxhash64("v", F.lit(k))) for k in range(LEADERS)])
                                         .alias("leaders"))
    first = (members.join(leaders, "sig").select("v", F.explode("leaders").alias("leader")).filter("v <> leader")
             .select(F.least("v", "leader").alias("a"), F.greatest("v", "leader").alias("b")).distinct())
    for side in "ab":
        first = first.join(vertices.select(*[F.col(c).alias(f"{side}_{c}") for c in vertices.columns]),
                           F.col(side) == F.col(f"{side}_v"))
    first = stored(first.filter(_may_link("a_", "b_", of, out_of)).select("a", "b"), "first-pairs")
    links = stored(_verified(first, picked, width, of, out_of), "first-links")

    parts = components(links)
    placed = members.join(parts, "v", "left").select("sig", "v", F.coalesce("component", "v").alias("component"))
    several = placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    rest = stored(placed.join(several.select("sig"), "sig", "left_semi").join(vertices, "v"), "open-groups")
    left, right = (rest.select("sig", *[F.col(c).alias(f"{s}_{c}") for c in rest.columns if c != "sig"]) for s in "ab")
    second = (left.join(right, "sig")
              .filter((F.col("a_v") < F.col("b_v")) & (F.col("a_component") != F.col("b_component"))
                      & _may_link("a_", "b_", of, out_of))
              .select(F.col("a_v").alias("a"), F.col("b_v").alias("b")).distinct()
              .join(first, ["a", "b"], "left_anti"))
    more = stored(_verified(stored(second, "second-pairs"), picked, width, of, out_of), "second-links")
    if not more.isEmpty():
        parts = components(links.unionByName(more))
    found = nodes.select("doc_id", "v").join(parts, "v", "left").select(
        F.col("doc_id").alias("_id"), F.coalesce("component", "v").alias("component_id"))
    return (sets.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component; rows without id stay.

    Only the ids that go are joined back; Spark broadcasts that table if it is small enough.
    """
    gone = jaccard_components(docs, id_col, text_col, **how).filter("doc_id <> component_id")
    gone = stored(gone.select(F.col("doc_id").alias("_gone")).distinct(), "copies")
    return docs.join(gone, docs[id_col].cast("bigint") == gone["_gone"], "left_anti")


def _may_link(a: str, b: str, of: int, out_of: int):
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    odd = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}")))
                                      for i in range(PARITY_WORDS)])
    return ((F.least(n_a, n_b) * out_of >= F.greatest(n_a, n_b) * of)
            & (odd * (out_of + of) <= (n_a + n_b) * (out_of - of)))


def _different_groups(members: DataFrame) -> DataFrame:
    """Groups of two classes or more; of groups with the same classes one."""
    groups = (members.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("v")).alias("x"),
                                         F.bit_xor(F.xxhash64(F.lit(7), "v")).alias("y")).filter("n > 1")
              .groupBy("n", "x", "y").agg(F.min("sig").alias("sig")))
    return members.join(groups.select("sig"), "sig", "left_semi")


def _sets(picked: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the set (128 bits), s0.. its parities in 1024 cells."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "fingerprint", *(f"s{i}" for i in range(PARITY_WORDS))]
        for batch in batches:
            for b in slices(batch, "text"):
                features, offsets = shingle_sets(b.column("text"), width)
                n = b.num_rows
                row = np.repeat(np.arange(n), np.diff(offsets))
                bit = (mix(features + np.uint64(0x5851F42D)) & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64)
                odd = np.bincount(row * 64 * PARITY_WORDS + bit, minlength=n * 64 * PARITY_WORDS) & 1
                parity = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(n, PARITY_WORDS)
                prints = [xxhash.xxh3_128_digest(features[i:j].tobytes()) for i, j in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(prints, pa.binary()),
                     *(pa.array(np.ascontiguousarray(parity[:, i])) for i in range(PARITY_WORDS))], names=names)

    parities = ", ".join(f"s{i} long" for i in range(PARITY_WORDS))
    return picked.mapInArrow(run, f"doc_id long, n_shingles long, fingerprint binary, {parities}")


def _members(picked: DataFrame, width: int, scheme: Scheme, buckets: int) -> DataFrame:
    """(sig, doc_id) of the signatures that several documents have, and of some that one class has."""
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, ids, seen = [], [], set()
            for b in slices(batch, "text"):
                features, offsets = shingle_sets(b.column("text"), width)
                sig, row = scheme.signatures(features, offsets)
                new = np.zeros(b.num_rows, bool)
                for i in range(b.num_rows):
                    key = xxhash.xxh3_128_digest(features[offsets[i]:offsets[i + 1]].tobytes())
                    new[i] = key not in seen
                    seen.add(key)
                use = new[row]
                sigs.append(sig[use])
                ids.append(b.column("doc_id").to_numpy(zero_copy_only=False)[row[use]])
            sig, doc = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (sigs, ids))
            if not len(sig):
                continue
            _, at, inverse, count = np.unique(sig, return_index=True, return_inverse=True, return_counts=True)
            frequent = count[inverse] >= FREQUENT
            to_bucket = ~frequent
            to_bucket[at] = True
            bucket = (sig % np.uint64(buckets)).astype(np.int64)
            # a frequent signature goes past the buckets: to tasks by its documents
            past = np.flatnonzero(frequent)
            yield from _packed(np.concatenate([bucket[to_bucket], -1 - doc[past] % (4 * buckets + 16)]),
                               np.concatenate([sig[to_bucket], sig[past]]),
                               np.concatenate([doc[to_bucket], doc[past]]))

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for bucket, sig, doc in zip(*(b.column(c).to_pylist() for c in ("bucket", "sigs", "docs"))):
                if bucket != now:
                    if held:
                        yield _shared(held, now)
                    now, held = bucket, []
                held.append((sig, doc))
        if held:
            yield _shared(held, now)

    dealt = picked.filter("doc_id IS NOT NULL").mapInArrow(deal, "bucket long, sigs binary, docs binary")
    return (dealt.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(gather, "sig long, doc_id long"))


def _packed(bucket: np.ndarray, sig: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(bucket, kind="stable")
    bucket, sig, doc = bucket[order], sig[order].astype(np.uint64), doc[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = np.append(first[1:], len(bucket))
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[first]), pa.array([sig[i:j].tobytes() for i, j in zip(first, ends)], pa.binary()),
         pa.array([doc[i:j].tobytes() for i, j in zip(first, ends)], pa.binary())], names=["bucket", "sigs", "docs"])


def _shared(held: list[tuple[bytes, bytes]], bucket: int) -> pa.RecordBatch:
    sig = np.frombuffer(b"".join(s for s, _ in held), np.int64)
    doc = np.frombuffer(b"".join(d for _, d in held), np.int64)
    if bucket >= 0:
        order = np.argsort(sig, kind="stable")
        sig, doc = sig[order], doc[order]
        same = sig[1:] == sig[:-1]
        several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        sig, doc = sig[several[:len(sig)]], doc[several[:len(doc)]]
    return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(doc)], names=["sig", "doc_id"])


def _verified(pairs: DataFrame, picked: DataFrame, width: int, of: int, out_of: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                features, offsets = shingle_sets(b.column("text"), width)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([features[i:j].tobytes() for i, j in zip(offsets, offsets[1:])],
                                                  pa.binary())], names=["v", "features"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("a_features"), b.column("b_features")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(out_of * common >= of * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(keep)), b.column("b").filter(pa.array(keep))],
                                             names=["a", "b"])

    asked = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-vertices")
    # one row of an id that repeats: rows that repeat an id are one document
    full = (picked.join(asked, "doc_id", "left_semi").mapInArrow(sets, "v long, features binary")
            .groupBy("v").agg(F.first("features").alias("features")))
    full = stored(full, "pair-sets")
    both = (pairs.join(full.select(F.col("v").alias("b"), F.col("features").alias("b_features")), "b")
            .join(full.select(F.col("v").alias("a"), F.col("features").alias("a_features")), "a"))
    return both.select("a", "b", "a_features", "b_features").mapInArrow(compare, "a long, b long")
