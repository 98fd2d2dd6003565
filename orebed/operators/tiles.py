"""Trees of cells over distinct points, grown until every leaf is small, and their dealing to tasks.

The driver holds numbers of cells, never points: it counts cells in a few passes, splits only
the overfull ones and decides by boxes alone which leaves a task has to see. Tasks receive
the points of their own leaves and of those leaves, and give back one row per own point.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.session import cut_lineage, release

CODE_BITS = 60  # bits of the place of a finest cell along the curve, over all axes, at most
AXIS_BITS = 40  # and on one axis: a double counts the cells exactly
TASK_POINTS = 40_000  # points of the leaves of one task, at most about
MAX_LEAVES = 16_000  # leaves grow beyond their wanted size only to keep about this number
PAIR_CELLS = 200_000  # distances held at once: they stay in the cache


def finest_level(dims: int) -> int:
    return min(AXIS_BITS, CODE_BITS // dims)


def _interleave(cells: np.ndarray, depth: int) -> np.ndarray:
    """Place along the curve of integer cells (rows x axes), the first axis in the highest bit."""
    dims = cells.shape[1]
    out = np.zeros(len(cells), np.int64)
    for bit in range(depth):
        for axis in range(dims):
            out |= ((cells[:, axis] >> bit) & 1) << (bit * dims + dims - 1 - axis)
    return out


def _separate(places: np.ndarray, dims: int, depth: int) -> np.ndarray:
    """Cells of places along the curve."""
    out = np.zeros((len(places), dims), np.int64)
    for bit in range(depth):
        for axis in range(dims):
            out[:, axis] |= ((places >> (bit * dims + dims - 1 - axis)) & 1) << bit
    return out


def runs(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass(frozen=True)
class Leaves:
    """Leaves of the trees of all codes, in order of code and curve; tasks find the leaf of a point in it."""

    dims: int
    depth: int
    first: np.ndarray  # first leaf of each code, and the number of leaves
    start: np.ndarray  # place of the first finest cell of each leaf
    node: np.ndarray

    def find(self, code: np.ndarray, place: np.ndarray) -> np.ndarray:
        lo, hi = self.first[code], self.first[code + 1] - 1
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            right = self.start[np.minimum(mid, len(self.start) - 1)] <= place
            lo, hi = np.where((lo < hi) & right, mid, lo), np.where((lo < hi) & ~right, mid - 1, hi)
        return lo


@dataclass
class Forest:
    """Cells of one tree per code: from the smallest cells around its points down to its leaves."""

    dims: int
    depth: int
    lows: np.ndarray
    span: float
    code: np.ndarray
    level: np.ndarray
    place: np.ndarray  # along the curve of the cells of the level
    count: np.ndarray  # distinct points
    parent: np.ndarray
    leaf: np.ndarray
    leaves: Leaves | None = None

    def finish(self, codes: int) -> None:
        """Derived columns: boxes, children, leaves in order, tasks."""
        self.cell = np.zeros((len(self.code), self.dims), np.int64)
        for level in np.unique(self.level):
            at = self.level == level
            self.cell[at] = _separate(self.place[at], self.dims, int(level))
        self.size = self.span / 2.0 ** self.level
        self.low = self.lows + self.cell * self.size[:, None]
        self.mid = self.low + self.size[:, None] / 2
        has = np.flatnonzero(self.parent >= 0)
        self.child = has[np.argsort(self.parent[has], kind="stable")]
        self.child_from = np.searchsorted(self.parent[self.child], np.arange(len(self.code) + 1))
        start = self.place << (self.dims * (self.depth - self.level.astype(np.int64)))
        node = np.flatnonzero(self.leaf)
        node = node[np.lexsort((start[node], self.code[node]))]
        first = np.searchsorted(self.code[node], np.arange(codes + 1))
        self.leaves = Leaves(self.dims, self.depth, first, start[node], node)
        before = np.cumsum(self.count[node]) - self.count[node]
        self.tasks = int(before[-1] // TASK_POINTS) + 1 if len(node) else 1
        self.task_from = np.full(len(self.code), self.tasks)
        self.task_to = np.full(len(self.code), -1)
        self.task_from[node] = self.task_to[node] = before // TASK_POINTS
        for level in np.unique(self.level)[::-1]:
            at = np.flatnonzero((self.level == level) & (self.parent >= 0))
            np.minimum.at(self.task_from, self.parent[at], self.task_from[at])
            np.maximum.at(self.task_to, self.parent[at], self.task_to[at])

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes, and the position of the node each belongs to."""
        n = self.child_from[nodes + 1] - self.child_from[nodes]
        return self.child[np.repeat(self.child_from[nodes], n) + runs(n)], np.repeat(np.arange(len(nodes)), n)


def placed(points: DataFrame, dims: int, lows: Sequence[float], span: float) -> DataFrame:
    """Points (code, x0.., ...) with the ``place`` of their finest cell along the curve."""
    depth = finest_level(dims)
    names = [f"x{i}" for i in range(dims)]
    lows = np.asarray(lows, float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            share = (b[names].to_numpy(float) - lows) / span
            cells = np.clip(np.floor(share * 2.0**depth), 0, 2**depth - 1).astype(np.int64)
            yield b.assign(place=_interleave(cells, depth))

    kinds = ", ".join(f"{c} {t}" for c, t in points.dtypes)
    return cut_lineage(points.mapInPandas(run, f"{kinds}, place long"))


def grow(points: DataFrame, dims: int, lows: Sequence[float], span: float, tops: np.ndarray, sizes: np.ndarray,
         cap: int) -> Forest:
    """One tree per code over placed points; ``tops`` is the level of the topmost cells, ``sizes`` the points of a code.

    A pass counts the cells that overfull leaves are expected to need; what is still overfull goes on.
    """
    depth, codes = finest_level(dims), len(sizes)
    cap = max(cap, -(-int(sizes.sum()) // MAX_LEAVES))
    more = lambda n: np.ceil(np.log2(np.maximum(n / cap, 1.0)) / dims).astype(np.int64) + (n > cap)
    empty = np.zeros(0, np.int64)
    found = Forest(dims, depth, np.asarray(lows, float), span, empty, empty, empty, empty, empty, np.zeros(0, bool))
    # at first every code is one leaf that has no node
    held = Leaves(dims, depth, np.arange(codes + 1), np.zeros(codes, np.int64), np.full(codes, -1))
    base, want = tops.astype(np.int64), np.minimum(depth, tops + more(sizes))
    while True:
        shared = points.sparkSession.sparkContext.broadcast((held, want))

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, want = shared.value
            for b in batches:
                place = b["place"].to_numpy()
                leaf = held.find(b["code"].to_numpy(), place)
                at = want[leaf]
                leaf, place, at = leaf[at >= 0], place[at >= 0], at[at >= 0]
                cells = pd.DataFrame({"leaf": leaf, "cell": place >> (dims * (depth - at))})
                yield cells.groupby(["leaf", "cell"], as_index=False).size().rename(columns={"size": "n"})

        cells = points.select("code", "place").mapInPandas(count, "leaf long, cell long, n long").groupBy(
            "leaf", "cell").agg(F.sum("n").alias("n")).toPandas()  # a few cells per leaf that is wanted
        shared.destroy()
        _add(found, held, cells, base, want, cap)
        found.finish(codes)
        leaf = found.leaves.node
        over = (found.count[leaf] > cap) & (found.level[leaf] < depth)
        if not over.any():
            return found
        held, base = found.leaves, found.level[leaf]
        want = np.where(over, np.minimum(depth, base + more(found.count[leaf])), -1)


def _add(found: Forest, held: Leaves, cells: pd.DataFrame, base: np.ndarray, want: np.ndarray, cap: int) -> None:
    """Adds the nodes below the leaves that were counted."""
    dims = found.dims
    by_level: dict[int, pd.DataFrame] = {}
    at = want[cells["leaf"].to_numpy()]
    above = cells.iloc[:0]
    for level in range(int(want.max()), -1, -1):
        rolled = above[base[above["leaf"].to_numpy()] <= level].assign(cell=lambda t: t["cell"].to_numpy() >> dims)
        level_cells = pd.concat([cells[at == level], rolled]).groupby(["leaf", "cell"], as_index=False)["n"].sum()
        by_level[level] = above = level_cells
    code_of = np.searchsorted(held.first, np.arange(len(held.node)), side="right") - 1
    kept: list[tuple] = []
    total = len(found.code)
    parents = pd.DataFrame({"leaf": [], "up": [], "id": []}, dtype=np.int64)
    for level in sorted(by_level):
        t = by_level[level]
        leaf, cell, n = (t[c].to_numpy(np.int64) for c in ("leaf", "cell", "n"))
        top = base[leaf] == level
        up = pd.DataFrame({"leaf": leaf, "up": cell >> dims}).merge(parents, "left", ["leaf", "up"])["id"].to_numpy()
        alive = top | ~np.isnan(up.astype(float))
        leaf, cell, n, top, up = leaf[alive], cell[alive], n[alive], top[alive], up[alive]
        end = (n <= cap) | (want[leaf] == level)
        known = top & (held.node[leaf] >= 0)  # the leaf that was counted is a node already
        ids = np.full(len(leaf), -1)
        ids[known] = held.node[leaf[known]]
        found.leaf[ids[known]] = end[known]
        new = ~known
        ids[new] = total + np.arange(new.sum())
        total += int(new.sum())
        up = np.where(top, -1, np.nan_to_num(up.astype(float), nan=-1)).astype(np.int64)
        kept.append((code_of[leaf][new], np.full(new.sum(), level), cell[new], n[new], up[new], end[new]))
        parents = pd.DataFrame({"leaf": leaf[~end], "up": cell[~end], "id": ids[~end]})
    for i, name in enumerate(("code", "level", "place", "count", "parent", "leaf")):
        column = getattr(found, name)
        setattr(found, name, np.concatenate([column, *[k[i] for k in kept]]).astype(column.dtype))


def gaps(forest: Forest, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance along each axis between the boxes of two nodes (pairs x axes)."""
    apart = np.abs(forest.mid[a] - forest.mid[b]) - (forest.size[a] + forest.size[b])[:, None] / 2
    return np.maximum(apart, 0.0)


def dealt(points: DataFrame, forest: Forest, source: np.ndarray, target: np.ndarray) -> DataFrame:
    """Rows (task, leaf, own, x0.., w): the points of each task's leaves, and those of the source leaves of its targets.

    ``source`` and ``target`` are pairs of a leaf and any node; a task sees a leaf once.
    """
    n = forest.task_to[target] - forest.task_from[target] + 1
    leaf_of = np.full(len(forest.code), -1)
    leaf_of[forest.leaves.node] = np.arange(len(forest.leaves.node))
    seen = np.repeat(leaf_of[source], n) * forest.tasks + np.repeat(forest.task_from[target], n) + runs(n)
    home = forest.task_from[forest.leaves.node]
    seen = np.unique(np.concatenate([seen, np.arange(len(home)) * forest.tasks + home]))
    leaf, task = seen // forest.tasks, (seen % forest.tasks).astype(np.int32)
    begin = np.searchsorted(leaf, np.arange(len(home) + 1))
    names = [f"x{i}" for i in range(forest.dims)]
    shared = points.sparkSession.sparkContext.broadcast((forest.leaves, home, begin, task))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaves, home, begin, task = shared.value
        for b in batches:
            if not len(b):
                continue
            leaf = leaves.find(b["code"].to_numpy(), b["place"].to_numpy())
            n = begin[leaf + 1] - begin[leaf]
            out = b[[*names, "w"]].take(np.repeat(np.arange(len(b)), n))
            to = task[np.repeat(begin[leaf], n) + runs(n)]
            leaf = np.repeat(leaf, n)
            yield out.assign(task=to, leaf=leaf.astype(np.int32), own=home[leaf] == to)

    coords = ", ".join(f"{x} double" for x in names)
    return points.select("code", "place", *names, "w").mapInPandas(deal, f"{coords}, w long, task int, leaf int, own boolean")


class Held:
    """Points of one task, by leaf."""

    def __init__(self, rows: pd.DataFrame, dims: int):
        rows = rows.iloc[np.argsort(rows["leaf"].to_numpy(), kind="stable")]
        leaf = rows["leaf"].to_numpy()
        self.x = np.stack([rows[f"x{i}"].to_numpy(float) for i in range(dims)], axis=1)
        self.w = rows["w"].to_numpy(float)
        self.leaves, begin = np.unique(leaf, return_index=True)
        self.slices = {v: slice(a, b) for v, a, b in zip(self.leaves.tolist(), begin, np.append(begin[1:], len(leaf)))}
        self.own = [v for v in self.leaves.tolist() if rows["own"].to_numpy()[self.slices[v].start]]


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(x rows, y rows) squared distances, axis by axis."""
    d2 = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = x[:, j : j + 1] - y[None, :, j]
        d2 += np.multiply(d, d, out=d)
    return d2


def kth_distances(points: DataFrame, dims: int, ks: Sequence[int]) -> DataFrame:
    """Distinct points (x0.., w) with the distance ``kd_<k>`` to their k-th row, themselves counted.

    A leaf or the smallest cell around it that holds the largest k points bounds all its distances by its
    diagonal, so only leaves within that reach meet it.
    """
    names = [f"x{i}" for i in range(dims)]
    most = max(ks)
    ends = points.agg(F.count(F.lit(1)), *[f(x) for x in names for f in (F.min, F.max)]).first()
    lows, highs = np.array(ends[1::2], float), np.array(ends[2::2], float)
    span = float((highs - lows).max()) or 1.0
    at = placed(points.select(F.lit(0).alias("code"), *names, "w"), dims, lows, span)
    forest = grow(at, dims, lows, span, np.zeros(1, np.int64), np.array([ends[0]]), max(128, 4 * most))
    # distances between places are known up to rounding: boxes are a little larger than their points
    slack = 1e-9 * (span + float(np.abs(np.concatenate([lows, highs])).max()))
    bound = np.full(len(forest.code), np.inf)
    for level in np.unique(forest.level):  # from the top: the parents are known
        node = np.flatnonzero(forest.level == level)
        up = forest.parent[node]
        held = np.where(up >= 0, bound[np.maximum(up, 0)], np.inf)
        bound[node] = np.where(forest.count[node] >= most, forest.size[node] * np.sqrt(dims) + slack, held)
    a, b = np.flatnonzero(forest.parent < 0), forest.leaves.node
    a, b = np.repeat(a, len(b)), np.tile(b, len(a))
    met = []
    while len(a):
        near = np.sqrt((gaps(forest, a, b) ** 2).sum(axis=1)) <= bound[b] + slack
        a, b = a[near], b[near]
        end = forest.leaf[a]
        met.append((a[end], b[end]))
        a, of = forest.children(a[~end])
        b = b[~end][of]
    a, b = (np.concatenate([m[i] for m in met]) for i in (0, 1))
    rows = dealt(at, forest, a, b)
    leaf_of = np.full(len(forest.code), -1)
    leaf_of[forest.leaves.node] = np.arange(len(forest.leaves.node))
    order = np.argsort(b, kind="stable")
    order = order[np.argsort(leaf_of[b[order]], kind="stable")]
    shared = points.sparkSession.sparkContext.broadcast(
        (leaf_of[a[order]], np.searchsorted(leaf_of[b[order]], np.arange(len(forest.leaves.node) + 1))))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        source, begin = shared.value
        held = Held(rows, dims)
        out = []
        for leaf in held.own:
            mine = held.slices[leaf]
            near = [held.slices[s] for s in source[begin[leaf] : begin[leaf + 1]].tolist()]
            y = np.concatenate([held.x[s] for s in near])
            w = np.concatenate([held.w[s] for s in near])
            x = held.x[mine]
            if len(x) >= most and len(y) > len(x):
                # no distance exceeds that to the k-th point of the own leaf
                reach = max(
                    np.partition(squared_distances(some, x), most - 1, axis=1)[:, most - 1].max()
                    for some in np.array_split(x, -(-len(x) * len(x) // PAIR_CELLS)))
                reach = np.sqrt(reach) * (1 + 1e-9) + slack
                inside = ((y >= x.min(axis=0) - reach) & (y <= x.max(axis=0) + reach)).all(axis=1)
                y, w = y[inside], w[inside]
            part = np.empty((len(x), len(ks)))
            step = max(1, PAIR_CELLS // len(y))
            for low in range(0, len(x), step):
                d2 = squared_distances(x[low : low + step], y)
                if len(y) > most:
                    pick = np.argpartition(d2, most - 1, axis=1)[:, :most]
                    d2, weight = np.take_along_axis(d2, pick, axis=1), w[pick]
                else:
                    weight = np.broadcast_to(w, d2.shape)
                order = np.argsort(d2, axis=1, kind="stable")
                d2 = np.take_along_axis(d2, order, axis=1)
                upto = np.cumsum(np.take_along_axis(weight, order, axis=1), axis=1)
                for j, k in enumerate(ks):
                    part[low : low + step, j] = np.sqrt(d2[np.arange(len(d2)), (upto < k).sum(axis=1)])
            found = {n: x[:, i] for i, n in enumerate(names)} | {"w": held.w[mine].astype(np.int64)}
            out.append(pd.DataFrame(found | {f"kd_{k}": part[:, j] for j, k in enumerate(ks)}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
            {n: np.zeros(0) for n in [*names, "w", *[f"kd_{k}" for k in ks]]})

    schema = ", ".join([f"{n} double" for n in names] + ["w long"] + [f"kd_{k} double" for k in ks])
    done = cut_lineage(rows.repartition(forest.tasks, "task").groupBy("task").applyInPandas(search, schema))
    release(at)
    return done
