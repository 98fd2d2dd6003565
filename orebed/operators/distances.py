"""Sums of Euclidean distances in the plane from every point to all points of a cluster, without all pairs.

Each cluster has its own tree of cells. Points of near leaves are compared one by one. Between cells at
least as far apart as they are wide, the distance is a smooth function of both places: it is interpolated at
``ORDER`` Chebyshev places per axis, which leaves about as much error as summing doubles does (a distance is off by
less than 1e-10 of itself at the worst place, a sum by about 1e-13), and a cell then stands for its points.
Work grows with the rows, not with their square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.operators.tiles import Forest, Held, dealt, finest_level, gaps, grow, placed
from orebed.session import cut_lineage, release

ORDER = 16  # interpolation places per axis
LEAF_POINTS = 512  # distinct points of a leaf, at most
TILE_ROWS, TILE_COLS = 100, 2_000  # distances held at once: they stay in the cache
KERNELS = 160  # matrices between two cells that a worker keeps
PAIR_BLOCK = 4_000_000  # pairs of a cell and a cluster that the driver tests at once

PLACES = np.cos((2 * np.arange(ORDER) + 1) * np.pi / (2 * ORDER))
_WAVES = np.cos(np.arange(ORDER)[:, None] * np.arccos(PLACES)[None, :]) * np.where(np.arange(ORDER) > 0, 2, 1)[:, None] / ORDER


def shares(u: np.ndarray) -> np.ndarray:
    """Share of each interpolation place in a value at u within [-1, 1]: (rows, ORDER)."""
    return np.cos(np.arccos(np.clip(u, -1.0, 1.0))[:, None] * np.arange(ORDER)) @ _WAVES


HALVES = [shares((PLACES + side) / 2) for side in (-1.0, 1.0)]  # places of a half cell in those of the whole


def places_of(low: np.ndarray, size: float) -> np.ndarray:
    """The interpolation places of a cell, the first axis slowest."""
    one = low[:, None] + size * (PLACES + 1) / 2
    return np.stack([np.repeat(one[0], ORDER), np.tile(one[1], ORDER)], axis=1)


def cell_shares(x: np.ndarray, low: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
    u = (x - low) / size * 2 - 1
    return shares(u[:, 0]), shares(u[:, 1])


@lru_cache(maxsize=KERNELS)
def kernel(rise: int, dx: int, dy: int) -> np.ndarray:
    """Distances between the places of two cells, in sizes of the smaller; ``rise`` is the level of the
    first over that of the second, dx and dy are between their middles in halves of that size."""
    a, b = 2.0 ** max(-rise, 0), 2.0 ** max(rise, 0)
    low = np.array([dx, dy]) / 2.0
    x, y = places_of(low - a / 2, a), places_of(np.full(2, -b / 2), b)
    return np.sqrt((x[:, :1] - y[None, :, 0]) ** 2 + (x[:, 1:] - y[None, :, 1]) ** 2)


def weighted_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of w times the distance to y, for each x."""
    out = np.zeros(len(x))
    for low in range(0, len(y), TILE_COLS):
        part, weight = y[low : low + TILE_COLS], w[low : low + TILE_COLS]
        for top in range(0, len(x), TILE_ROWS):
            some = x[top : top + TILE_ROWS]
            d2 = some[:, :1] - part[None, :, 0]
            np.multiply(d2, d2, out=d2)
            d = some[:, 1:] - part[None, :, 1]
            d2 += np.multiply(d, d, out=d)
            out[top : top + TILE_ROWS] += np.sqrt(d2, out=d2) @ weight
    return out


class Clusters:
    """Row count, centre and spread per cluster, which bound its mean distance to any place."""

    def __init__(self, sizes: np.ndarray, centres: np.ndarray, spread2: np.ndarray, slack: float):
        self.sizes, self.centres, self.spread2, self.slack = sizes, centres, spread2, slack

    def least(self, forest: Forest, node: np.ndarray, other: np.ndarray) -> np.ndarray:
        """No mean distance from a place of the cell to the cluster is smaller: a mean is at least that to the centre."""
        gap = np.maximum(np.abs(forest.mid[node] - self.centres[other]) - forest.size[node][:, None] / 2, 0.0)
        return np.sqrt((gap**2).sum(axis=1)) * (1 - 1e-9) - self.slack

    def most(self, forest: Forest, node: np.ndarray, other: np.ndarray) -> np.ndarray:
        """No mean distance is larger: a mean is at most the root of the mean square."""
        reach = np.abs(forest.mid[node] - self.centres[other]) + forest.size[node][:, None] / 2
        return np.sqrt((reach**2).sum(axis=1) + self.spread2[other]) * (1 + 1e-9) + self.slack

    def limits(self, forest: Forest) -> np.ndarray:
        """Per node: the nearest other cluster is, on average, no farther than this from any place of the cell."""
        k = len(self.sizes)
        out = np.full(len(forest.code), np.inf)
        step = max(1, PAIR_BLOCK // k)
        for low in range(0, len(out), step):
            node = np.arange(low, min(low + step, len(out)))
            most = self.most(forest, np.repeat(node, k), np.tile(np.arange(k), len(node))).reshape(len(node), k)
            most[np.arange(len(node)), forest.code[node]] = np.inf
            out[node] = most.min(axis=1)
        return out


def meetings(forest: Forest, clusters: Clusters, limits: np.ndarray) -> dict[str, np.ndarray]:
    """Pairs of a source and a target node, by what stands for either: (2, pairs) for places or points of both.

    Together they hold every pair of points once. A target leaves out the clusters that cannot be its nearest.
    """
    k = len(clusters.sizes)
    tops = np.flatnonzero(forest.parent < 0)
    tops = tops[np.argsort(forest.code[tops], kind="stable")]
    first = np.searchsorted(forest.code[tops], np.arange(k + 1))

    def wanted(code: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (code == forest.code[b]) | (clusters.least(forest, b, code) <= limits[b])

    a, b = [], []
    step = max(1, PAIR_BLOCK // k)
    for low in range(0, len(tops), step):
        node = tops[low : low + step]
        code, node = np.tile(np.arange(k), len(node)), np.repeat(node, k)
        hit = wanted(code, node)
        for c, t in zip(code[hit].tolist(), node[hit].tolist()):
            a.append(tops[first[c] : first[c + 1]])
            b.append(np.full(first[c + 1] - first[c], t))
    a, b = np.concatenate(a), np.concatenate(b)
    found: dict[str, list] = {"cell_cell": [], "cell_points": [], "points_cell": [], "points_points": []}
    while len(a):
        hit = wanted(forest.code[a], b)
        a, b = a[hit], b[hit]
        gap = gaps(forest, a, b).max(axis=1) * (1 + 1e-9)
        far_a, far_b = gap >= forest.size[a], gap >= forest.size[b]
        end_a, end_b = forest.leaf[a], forest.leaf[b]
        kinds = {
            "cell_cell": far_a & far_b, "cell_points": far_a & ~far_b & end_b, "points_cell": far_b & ~far_a & end_a,
            "points_points": ~far_a & ~far_b & end_a & end_b,
        }
        rest = np.ones(len(a), bool)
        for kind, at in kinds.items():
            found[kind].append(np.stack([a[at], b[at]]))
            rest &= ~at
        a, b, end_a, end_b = a[rest], b[rest], end_a[rest], end_b[rest]
        first_side = ~end_a & (end_b | (forest.size[a] >= forest.size[b]))
        down_a, of_a = forest.children(a[first_side])
        down_b, of_b = forest.children(b[~first_side])
        a, b = np.concatenate([down_a, a[~first_side][of_b]]), np.concatenate([b[first_side][of_a], down_b])
    return {kind: np.concatenate(parts, axis=1) for kind, parts in found.items()}


def cell_weights(at: DataFrame, forest: Forest) -> np.ndarray:
    """Weights at the interpolation places of every node that stand for its points: (nodes, ORDER, ORDER)."""
    leaves, low, size = forest.leaves, forest.low, forest.size
    none = np.zeros(0, np.int64)
    own = dealt(at, forest, none, none)
    shared = at.sparkSession.sparkContext.broadcast((low[leaves.node], size[leaves.node]))

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        low, size = shared.value
        held = Held(rows, 2)
        out = []
        for leaf in held.own:
            s = held.slices[leaf]
            u, v = cell_shares(held.x[s], low[leaf], size[leaf])
            out.append(((u * held.w[s][:, None]).T @ v).tobytes())
        return pd.DataFrame({"leaf": np.array(held.own, np.int64), "weights": out})

    folded = own.repartition(forest.tasks, "task").groupBy("task").applyInPandas(fold, "leaf long, weights binary")
    weights = np.zeros((len(forest.code), ORDER, ORDER))
    for row in folded.collect():  # one row per leaf: a bounded number beyond a few per cluster
        weights[leaves.node[row["leaf"]]] = np.frombuffer(row["weights"]).reshape(ORDER, ORDER)
    for level in np.unique(forest.level)[::-1]:
        node = np.flatnonzero((forest.level == level) & (forest.parent >= 0))
        for i in (0, 1):
            for j in (0, 1):
                part = node[(forest.cell[node, 0] % 2 == i) & (forest.cell[node, 1] % 2 == j)]
                np.add.at(weights, forest.parent[part], HALVES[i].T @ weights[part] @ HALVES[j])
    shared.destroy()
    return weights


def cluster_distances(
    points: DataFrame, sizes: np.ndarray, centres: np.ndarray, spread2: np.ndarray, all_sums: bool = False,
) -> DataFrame:
    """Distances of distinct points (code, x0, x1, w) to the clusters 0..k-1 that ``sizes`` rows belong to.

    Columns code, x0, x1 and either ``inner`` and ``outer``, the sum of distances to the own cluster and the
    smallest mean to another one, or, for ``all_sums``, ``other`` and ``total`` per cluster.
    """
    k = len(sizes)
    ends = points.agg(*[f(x) for x in ("x0", "x1") for f in (F.min, F.max)]).first()
    lows, highs = np.array(ends[0::2], float), np.array(ends[1::2], float)
    span = float((highs - lows).max()) or 1.0
    at = placed(points, 2, lows, span)
    boxes = at.groupBy("code").agg(F.count(F.lit(1)), *[f(x) for x in ("x0", "x1") for f in (F.min, F.max)]).collect()
    counts, width = np.zeros(k, np.int64), np.zeros(k)
    for row in boxes:  # one row per cluster
        counts[row[0]], width[row[0]] = row[1], max(row[3] - row[2], row[5] - row[4])
    # topmost cells are as wide as the cluster, so it spans four at most
    tops = np.floor(np.log2(span / np.maximum(width, span / 2.0 ** (finest_level(2))))).astype(np.int64)
    forest = grow(at, 2, lows, span, np.clip(tops, 0, finest_level(2)), counts, LEAF_POINTS)
    clusters = Clusters(sizes, centres, spread2, 1e-9 * (span + float(np.abs(np.concatenate([lows, highs])).max())))
    limits = np.full(len(forest.code), np.inf) if all_sums else clusters.limits(forest)
    met = meetings(forest, clusters, limits)
    weights = cell_weights(at, forest)
    pairs = {}
    for kind, (a, b) in met.items():
        order = np.argsort(b, kind="stable")
        pairs[kind] = (a[order].astype(np.int32), np.searchsorted(b[order], np.arange(len(forest.code) + 1)))
    points_met = np.concatenate([met["points_cell"], met["points_points"]], axis=1)
    rows = dealt(at, forest, *points_met)
    shared = points.sparkSession.sparkContext.broadcast((forest, clusters, limits, weights, pairs))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        return _task_sums(group, *shared.value, all_sums)

    schema = "code int, x0 double, x1 double, " + ("other int, total double" if all_sums else "inner double, outer double")
    done = cut_lineage(rows.repartition(forest.tasks, "task").groupBy("task").applyInPandas(meet, schema))
    release(at)
    shared.destroy()
    return done


def _pairs_of(pairs: tuple[np.ndarray, np.ndarray], nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    source, begin = pairs
    n = begin[nodes + 1] - begin[nodes]
    at = np.repeat(begin[nodes] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return source[at], np.repeat(nodes, n)


def _task_sums(group: pd.DataFrame, forest: Forest, clusters: Clusters, limits: np.ndarray, weights: np.ndarray,
               pairs: dict, all_sums: bool) -> pd.DataFrame:
    """Distances of the own points of a task."""
    k = len(clusters.sizes)
    task = int(group["task"].iloc[0])
    held = Held(group, 2)
    leaf_of = {int(n): i for i, n in enumerate(forest.leaves.node)}
    nodes = np.flatnonzero((forest.task_from <= task) & (forest.task_to >= task))
    # values at the places of target cells, per cluster that the distances are summed over
    a, b = _pairs_of(pairs["cell_cell"], nodes)
    pa, pb = _pairs_of(pairs["points_cell"], nodes)
    keys, of = np.unique(np.concatenate([b * np.int64(k) + forest.code[a], pb * np.int64(k) + forest.code[pa]]), return_inverse=True)
    values = np.zeros((len(keys), ORDER * ORDER))
    finest = np.maximum(forest.level[a], forest.level[b])
    double_mid = lambda n: (2 * forest.cell[n] + 1) << (forest.depth - forest.level[n])[:, None]
    step = (double_mid(a) - double_mid(b)) >> (forest.depth - finest)[:, None]
    kinds, kind_of = np.unique(np.column_stack([forest.level[a] - forest.level[b], step]), axis=0, return_inverse=True)
    kind_of = kind_of.ravel()
    order = np.argsort(kind_of, kind="stable")
    unit = forest.span / 2.0**finest
    for kind, at in zip(kinds.tolist(), np.split(order, np.searchsorted(kind_of[order], np.arange(1, len(kinds))))):
        # a target meets one source cell of a cluster at this step, so no row comes twice
        values[of[at]] += (weights[a[at]].reshape(len(at), -1) @ kernel(*kind)) * unit[at][:, None]
    for i, (s, t) in enumerate(zip(pa.tolist(), pb.tolist())):
        part = held.slices[leaf_of[s]]
        values[of[len(a) + i]] += weighted_sums(places_of(forest.low[t], forest.size[t]), held.x[part], held.w[part])
    at_node: dict[int, dict[int, np.ndarray]] = {int(n): {} for n in nodes}
    for key, value in zip(keys.tolist(), values.reshape(-1, ORDER, ORDER)):
        at_node[key // k][key % k] = value
    for n in nodes[np.argsort(forest.level[nodes], kind="stable")].tolist():
        for child in forest.child[forest.child_from[n] : forest.child_from[n + 1]].tolist():
            if child not in at_node:
                continue
            i, j = forest.cell[child] % 2
            for code, value in at_node[n].items():
                down = HALVES[i] @ value @ HALVES[j].T
                at_node[child][code] = at_node[child][code] + down if code in at_node[child] else down
    out = []
    for leaf in held.own:
        n = int(forest.leaves.node[leaf])
        x, code = held.x[held.slices[leaf]], int(forest.code[n])
        near, _ = _pairs_of(pairs["points_points"], np.array([n]))
        cells, _ = _pairs_of(pairs["cell_points"], np.array([n]))
        asked = np.unique(np.concatenate([forest.code[near], forest.code[cells], list(at_node[n])])).astype(np.int64)
        here = np.full(len(asked), n)
        # a little stricter than above the leaf, so that no sum is left incomplete by rounding
        asked = asked[(asked == code) | (clusters.least(forest, here, asked) <= limits[here] - clusters.slack / 2)]
        u, v = cell_shares(x, forest.low[n], forest.size[n]) if at_node[n] else (None, None)
        inner, outer = np.zeros(len(x)), np.full(len(x), np.nan)
        base = {"code": np.full(len(x), code, np.int32), "x0": x[:, 0], "x1": x[:, 1]}
        for other in asked.tolist():
            parts = [held.slices[leaf_of[s]] for s in near[forest.code[near] == other].tolist()]
            far = cells[forest.code[cells] == other].tolist()
            y = [held.x[s] for s in parts] + [places_of(forest.low[s], forest.size[s]) for s in far]
            w = [held.w[s] for s in parts] + [weights[s].ravel() for s in far]
            total = weighted_sums(x, np.concatenate(y), np.concatenate(w)) if y else np.zeros(len(x))
            if other in at_node[n]:
                total += ((u @ at_node[n][other]) * v).sum(axis=1)
            if all_sums:
                out.append(pd.DataFrame(base | {"other": np.full(len(x), other, np.int32), "total": total}))
            elif other == code:
                inner = total
            else:
                outer = np.fmin(outer, total / clusters.sizes[other])
        if not all_sums:
            out.append(pd.DataFrame(base | {"inner": inner, "outer": outer}))
    return pd.concat(out, ignore_index=True)
