"""PartEnum signatures of feature sets: sets of like size that are similar enough share one.

Sizes are cut into bands [l, floor(l / t)]; two sets of Jaccard similarity t or more lie in one band
or in neighbouring ones.  Instance j of the scheme serves the pairs whose larger band is j, so a set
of band i takes part in instances i and i + 1.  Two such sets of an instance differ in at most k
features.  The feature domain is cut into n1 partitions; as k < 2 * (n1 - slack) two similar sets
differ in at most one feature in some partition.  Each partition is cut into n2 cells; a difference
of one feature lies in one cell, so the features in the other n2 - 1 cells are the same.  The
enumerated subsets of a partition's cells are those that leave one cell out, and a signature is a
hash of the set's features in such a subset.  Where k is 0 the whole set is the one signature.

A subset without features says nothing and would bring unlike sets together.  A set leaves these out
as long as enough partitions remain in which it has features in two cells or more: by the counting
above one of those then has the shared, filled subset.  Only a set with too few of them keeps its
empty subsets as signatures.
"""

from __future__ import annotations

import numpy as np

from pricewh.llm.shingles import mix

FAR_SIZE = 1 << 40


class Scheme:
    """Bands and partition counts for the similarity ``of / out_of`` (as 85 / 100)."""

    def __init__(self, of: int, out_of: int, largest: int):
        self.of, self.out_of = of, out_of
        lows, l = [], 1
        while l <= max(largest, 1) * 2:
            lows.append(l)
            l = l * out_of // of + 1
        lows.append(l)
        self.lows = np.array(lows, np.int64)                    # band i: lows[i] .. lows[i + 1] - 1
        tops = self.lows[1:] - 1
        self.k = 2 * tops * (out_of - of) // (out_of + of)      # most differences in instance i
        self.n1 = np.where(self.k < 2, 1, self.k // 2 + 2 + self.k // 32)
        self.n2 = np.where(self.k == 0, 1, np.where(self.k == 1, 6, 3))

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, side="right") - 1

    def signatures(self, features: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signatures, row of each) of sets of distinct features; empty sets have none."""
        sizes = np.diff(offsets)
        rows = np.flatnonzero(sizes)
        if not len(rows):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        found = [self._of_instance(features, offsets, rows, self.band(sizes[rows]) + up) for up in (0, 1)]
        return np.concatenate([s for s, _ in found]), np.concatenate([r for _, r in found])

    def _of_instance(self, features, offsets, rows, instance) -> tuple[np.ndarray, np.ndarray]:
        size = offsets[rows + 1] - offsets[rows]
        n1, n2 = self.n1[instance], self.n2[instance]
        cells = n1 * n2
        first = np.concatenate([[0], np.cumsum(cells)])          # cells of a row
        at = np.repeat(offsets[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        own = features[at]
        cell = (mix(own) % np.repeat(cells, size).astype(np.uint64)).astype(np.int64) + np.repeat(first[:-1], size)
        total = np.zeros(first[-1], np.uint64)
        filled = np.bincount(cell, minlength=first[-1]).astype(np.int64)
        with np.errstate(over="ignore"):
            np.add.at(total, cell, mix(own + np.uint64(0xA0761D6478BD642F)))
            # partitions: n2 cells that stand together
            part_first = first[:-1].repeat(n1) + (np.arange(n1.sum()) - np.repeat(np.cumsum(n1) - n1, n1)) * np.repeat(n2, n1)
            in_part, filled_part = np.add.reduceat(total, part_first), np.add.reduceat(filled, part_first)
            cells_filled = np.add.reduceat((filled > 0).astype(np.int64), part_first)
            per = np.repeat(n2, n1)                              # cells of each partition
            part_of = np.repeat(np.arange(len(per)), per)
            left_out = np.where(np.repeat(n2, cells) == 1, np.uint64(0), total)
            rest = in_part[part_of] - left_out
            row_of_cell = np.repeat(np.arange(len(rows)), cells)
            name = (np.arange(first[-1]) - first[row_of_cell]).astype(np.uint64) * np.uint64(2_000_003) \
                + instance[row_of_cell].astype(np.uint64)
            signature = mix(rest + mix(name + np.uint64(1)))
        empty = filled_part[part_of] == np.where(np.repeat(n2, cells) == 1, 0, filled)
        # partitions with features in two cells or more, against the differences that a set of this size can have
        wide = np.add.reduceat((cells_filled > 1).astype(np.int64), np.concatenate([[0], np.cumsum(n1)[:-1]]))
        differ = size * (self.out_of - self.of) * (self.of + self.out_of) // (self.of * (self.out_of + self.of))
        keeps_empty = (n2 > 1) & (wide * 2 <= np.minimum(differ, self.k[instance]))
        keep = ~empty | keeps_empty[row_of_cell]
        return signature[keep], rows[row_of_cell[keep]]
