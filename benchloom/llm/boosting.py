"""Gradient-boosted trees over a table of numbers, with monotonic constraints, as flat node arrays.

All rows count, however many. A tree is grown level by level from sums over the rows, by node, feature and bin: each
task adds up its own blocks of rows, and only the sums, whose size does not depend on the rows, come to the driver. They
are whole numbers of 2**-32, so a fit does not depend on how the rows lie; there may be 2**31 of them. The bins end at
exact quantiles. Scoring walks all rows down all trees at once.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.llm import ranks
from benchloom.llm.ship import arrow_map

_SCALE = 2.0**32
#: Rows that a task's block has at least, where there are as many; a block's sums stay exact below 2**21.
BLOCK_ROWS = 1 << 16
#: Trees after which the rows' log odds are added up anew and kept.
KEPT_EVERY = 4
#: The bins of a feature are bytes.
MOST_BINS = 256

class Trees(NamedTuple):
    """Complete binary trees: the children of node i are 2i + 1 (value at most the threshold) and 2i + 2."""

    feature: np.ndarray  # tree, inner node
    threshold: np.ndarray  # tree, inner node
    value: np.ndarray  # tree, leaf
    base: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        total, inner = np.full(len(rows), self.base), self.feature.shape[1] if len(self.feature) else 0
        every = np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(rows), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += value[node - inner]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1 / (1 + np.exp(-self.raw(rows)))


class Block(NamedTuple):
    binned: np.ndarray  # row, feature
    labels: np.ndarray
    total: np.ndarray  # log odds by the trees so far

    def nodes(self, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row reaches on a level; ``cut`` is the last bin that goes left."""
        node, every = np.zeros(len(self.labels), np.int64), np.arange(len(self.labels))
        for _ in range(depth):
            node = 2 * node + 1 + (self.binned[every, feature[node]] > cut[node])
        return node - (2**depth - 1)

    def grown(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> Block:
        total = self.total.copy()
        for feature, cut, value in trees:
            total += value[self.nodes(feature, cut, depth)]
        return self._replace(total=total)

    def sums(self, feature: np.ndarray, cut: np.ndarray, level: int, bins: int) -> np.ndarray:
        """Slopes, curvatures and rows: (3, node of the level, feature, bin)."""
        p = 1 / (1 + np.exp(-self.total))
        weights = np.rint((self.labels - p) * _SCALE), np.rint(p * (1 - p) * _SCALE), None
        first, size = self.nodes(feature, cut, level) * bins, 2**level * bins
        out = np.empty((3, self.binned.shape[1], size), np.int64)
        for f in range(self.binned.shape[1]):
            place = first + self.binned[:, f]
            for sums, weight in zip(out, weights, strict=True):
                sums[f] = np.bincount(place, weight, size)
        return out.reshape(3, -1, 2**level, bins).swapaxes(1, 2)


def _bin(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x, "left") for e, x in zip(edges, rows.T, strict=True)], axis=1).astype(np.uint8)


def _base(n: int, good: float) -> float:
    return float(np.log((good + 1) / (n - good + 1)))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    signs: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    least: int = 20,
    ridge: float = 1.0,
) -> Trees:
    """Fit label 1 against 0. ``signs``: for each feature 1 or -1 where the score may only rise or fall with it, else 0.

    Without rows of both labels the score is one half plus what the share of labels says.
    """
    n, good = len(labels), float(labels.sum())
    if not 0 < good < n:
        return _trees([], depth, _base(n, good))
    edges = [np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) for x in rows.T]
    binned = _bin(rows, edges)
    starts = range(0, n, BLOCK_ROWS)
    blocks = [Block(binned[i : i + BLOCK_ROWS], labels[i : i + BLOCK_ROWS], np.full(len(labels[i : i + BLOCK_ROWS]), _base(n, good))) for i in starts]
    grown: list = []
    for _ in range(trees):
        tree = _tree(
            lambda feature, cut, level: reduce(np.add, [x.sums(feature, cut, level, bins) for x in blocks]),
            edges, signs, depth, bins, least, ridge, rate,
        )
        grown.append(tree)
        blocks = [x.grown([(tree[0], tree[2], tree[3])], depth) for x in blocks]
    return _trees(grown, depth, _base(n, good))


def fit_frame(
    rows: DataFrame,
    signs: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    least: int = 20,
    ridge: float = 1.0,
) -> Trees:
    """The same over all rows ``features array<double>, label int`` of a frame, which is read several times."""
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("good")).first()
    n, base = size["n"], _base(size["n"], float(size["good"]))
    if not 0 < size["good"] < n:
        return _trees([], depth, base)
    values = rows.select(F.posexplode("features").alias("part", "value"))
    found = ranks.quantiles(values, dict.fromkeys(range(len(signs)), n), np.linspace(0, 1, bins + 1)[1:-1])
    edges = [np.unique(found[f]) for f in range(len(signs))]

    def narrow(batches):
        for batch in batches:
            features = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(signs))
            labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)
            if len(labels):
                yield pa.record_batch([pa.array([_bin(features, edges).tobytes()]), pa.array([labels.tobytes()])], names=["binned", "labels"])

    def blocks(packed):
        binned, labels, held = [], [], 0

        def block():
            return Block(np.concatenate(binned), np.concatenate(labels), np.full(held, base))

        for row in packed:
            binned.append(np.frombuffer(row["binned"], np.uint8).reshape(-1, len(signs)))
            labels.append(np.frombuffer(row["labels"], np.uint8))
            held += len(labels[-1])
            if held >= BLOCK_ROWS:
                yield block()
                binned, labels, held = [], [], 0
        if held:
            yield block()

    packed = arrow_map(rows, narrow, "binned binary, labels binary").rdd
    state = packed.coalesce(-(-n // BLOCK_ROWS)).mapPartitions(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    grown: list = []
    older, fresh = None, []
    for number in range(trees):

        def sums(feature, cut, level, state=state, fresh=tuple(fresh)):
            def task(blocks):
                for block in blocks:
                    yield block.grown(fresh, depth).sums(feature, cut, level, bins)

            # One array of a task: what the rest of the way adds up does not grow with the rows.
            return state.mapPartitions(lambda x: [reduce(np.add, part)] if (part := [*task(x)]) else []).treeReduce(np.add)

        tree = _tree(sums, edges, signs, depth, bins, least, ridge, rate)
        grown.append(tree)
        fresh.append((tree[0], tree[2], tree[3]))
        if older is not None:  # its successor is stored by now
            older.unpersist()
            older = None
        if len(fresh) == KEPT_EVERY and number + 1 < trees:
            older, added = state, tuple(fresh)
            state = state.map(lambda block, added=added: block.grown(added, depth)).persist(StorageLevel.MEMORY_AND_DISK)
            fresh = []
    state.unpersist()
    return _trees(grown, depth, base)


def _trees(grown: list, depth: int, base: float) -> Trees:
    inner = 2**depth - 1
    return Trees(
        np.array([x[0] for x in grown], np.int64).reshape(-1, inner),
        np.array([x[1] for x in grown], float).reshape(-1, inner),
        np.array([x[3] for x in grown], float).reshape(-1, inner + 1),
        base,
    )


def _tree(sums, edges, signs, depth, bins, least, ridge, rate):
    """(features, thresholds, cuts, values) of a tree; ``sums(features, cuts, level)`` are those of ``Block.sums`` over all
    rows."""
    inner = 2**depth - 1
    feature, threshold, cut = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, MOST_BINS)
    limits, weight = {0: (-np.inf, np.inf)}, {}
    for at in range(inner):
        level = (at + 1).bit_length() - 1
        if at + 1 == 2**level:
            found = sums(feature, cut, level)
        low, high = limits[at]
        slope, curve, count = found[:, at + 1 - 2**level]
        g_all, h_all, c_all = slope[0].sum() / _SCALE, curve[0].sum() / _SCALE, count[0].sum()
        best = None
        for f in range(len(slope)):
            g, h = (np.cumsum(x)[:-1] / _SCALE for x in (slope[f], curve[f]))
            c = np.cumsum(count[f])[:-1]
            left = np.clip(g / (h + ridge), low, high)
            right = np.clip((g_all - g) / (h_all - h + ridge), low, high)
            # What the loss falls by with these values, to the second order.
            gain = (g * left - (h + ridge) * left**2 / 2) + ((g_all - g) * right - (h_all - h + ridge) * right**2 / 2)
            fits = (c >= least) & (c_all - c >= least) & (signs[f] * (right - left) >= 0)
            fits &= np.arange(len(g)) < len(edges[f])
            if fits.any():
                k = int(np.argmax(np.where(fits, gain, -np.inf)))
                if best is None or gain[k] > best[0]:
                    best = (gain[k], f, k, left[k], right[k], g[k], h[k])
        limits[2 * at + 1] = limits[2 * at + 2] = (low, high)
        if best is None:
            weight[2 * at + 1], weight[2 * at + 2] = (g_all, h_all), (0.0, 0.0)  # the threshold is infinite
            continue
        _, f, k, left, right, g, h = best
        feature[at], threshold[at], cut[at] = f, edges[f][k], k
        weight[2 * at + 1], weight[2 * at + 2] = (g, h), (g_all - g, h_all - h)
        if signs[f]:
            middle = (left + right) / 2
            first, second = ((low, middle), (middle, high))
            limits[2 * at + 1], limits[2 * at + 2] = (first, second) if signs[f] > 0 else (second, first)
    value = [np.clip(weight[at][0] / (weight[at][1] + ridge), *limits[at]) for at in range(inner, 2 * inner + 1)]
    return feature, threshold, cut, np.array(value) * rate
