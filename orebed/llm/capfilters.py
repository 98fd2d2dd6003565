"""Near-duplicate vectors by spherical-cap filters.

Filter directions are products: a randomly rotated vector is cut into blocks and
every choice of one random unit codeword per block is a direction. A vector
belongs to all filters whose cap it falls into; they are found block by block,
dropping partial choices that can no longer reach the cap. The more vectors a
label has, the narrower the caps and the more of them, so that a filter holds a
few unrelated vectors at any size. Vectors that share a filter are compared in
double precision. A pair is counted at its smallest common filter only, so links
are summed without ever listing pairs; crowded filters are cut into blocks that
meet in separate tasks. Links become components by label passing.

Defined results: vectors are compared only when label and length are equal and
not null; vectors that are null, empty or zero, or that hold null or non-finite
components, link with nothing; equal vectors of a label are one class and linked
with each other; null ids count as largest; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import cut, tasks_for
from orebed.operators.components import connected_components

HITS = 32.0  # filters that hold a vector, on average
LEAST_HITS = 32  # a vector in fewer caps also joins those that it comes closest to
DEEPER = 16.0  # how much wider the caps are that a vector may join so
CROWD = 4.0  # unrelated vectors of a label in a filter, on average
WIDEST = 0.02  # largest share of directions in a cap
CODEWORDS = 1024  # of one block, at most
BLOCK_ROWS = 2000  # vectors of one side of a comparison task
SMALL_TASK = 48  # rows up to which tasks are compared many at once
SEED = 20_011


@dataclass(frozen=True)
class CapPlan:
    """Parameters of the filters for vectors of one length."""

    dim: int
    blocks: int
    codewords: int
    height: float  # least inner product with a direction
    joined: float  # the same for the caps that vectors in few others may join


def _cap_share(dim: int, height: float) -> float:
    """Share of a sphere's directions whose inner product with a fixed one is at least ``height``."""
    if dim == 1:
        return 0.5 if height <= 1 else 0.0
    angle = math.acos(min(1.0, height))
    grid = np.linspace(0, math.pi, 200_001)
    density = np.sin(grid) ** (dim - 2)
    return float(np.trapezoid(np.where(grid <= angle, density, 0.0), grid) / np.trapezoid(density, grid))


@lru_cache(maxsize=64)
def cap_plan(dim: int, rows: int, least: float = 0.98) -> CapPlan:
    """Caps such that about CROWD of ``rows`` unrelated vectors and HITS filters meet a vector.

    A cap is at least twice as wide as the angle of the pairs to be found, which
    matters where vectors are short.
    """
    share = max(min(WIDEST, CROWD / max(rows, 1)), _cap_share(dim, max(0.0, 2 * least**2 - 1) if least > 0 else 0.0))

    def height(aim: float) -> float:
        low, high = 0.0, 1.0
        for _ in range(40):
            middle = (low + high) / 2
            low, high = (middle, high) if _cap_share(dim, middle) > aim else (low, middle)
        return low

    wanted = HITS / share
    blocks = 1 if dim < 8 else max(2, math.ceil(math.log(wanted) / math.log(CODEWORDS)))
    return CapPlan(dim, blocks, math.ceil(wanted ** (1 / blocks)), height(share), height(min(0.5, DEEPER * share)))


@lru_cache(maxsize=8)
def _codebook(plan: CapPlan) -> tuple[np.ndarray, list[np.ndarray]]:
    """Random rotation and the unit codewords of each block."""
    rng = np.random.default_rng(SEED)
    turn = np.linalg.qr(rng.standard_normal((plan.dim, plan.dim)))[0]
    words = []
    for part in np.array_split(np.arange(plan.dim), plan.blocks):
        w = rng.standard_normal((plan.codewords, len(part)))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / math.sqrt(plan.blocks))
    return turn, words


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def decode(vectors: np.ndarray, plan: CapPlan) -> list[np.ndarray]:
    """Numbers of all filters that hold each (unit) vector."""
    turn, words = _codebook(plan)
    parts = np.array_split(vectors @ turn, np.cumsum([w.shape[1] for w in words])[:-1], axis=1)
    scores = [p @ w.T for p, w in zip(parts, words, strict=True)]
    rest = np.cumsum([s.max(axis=1) for s in scores[::-1]], axis=0)[::-1]  # best of this block and all later ones
    row, code, total = np.arange(len(vectors)), np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
    for b, s in enumerate(scores):
        reach = total[:, None] + s[row]
        later = rest[b + 1][row] if b + 1 < len(scores) else 0.0
        at, k = np.nonzero(reach >= (plan.joined - later)[:, None] if b + 1 < len(scores) else reach >= plan.joined)
        row, code, total = row[at], code[at] * plan.codewords + k, reach[at, k]
    order = np.lexsort((code, -total, row))
    row, code, total = row[order], code[order], total[order]
    starts = np.searchsorted(row, np.arange(len(vectors)))
    keep = (total >= plan.height) | (np.arange(len(row)) - starts[row] < LEAST_HITS)
    row, code = row[keep], code[keep]
    return np.split(code, np.searchsorted(row, np.arange(1, len(vectors))))


def filter_lists(classes: DataFrame, rows: int, least: float) -> DataFrame:
    """(cid, filters) of every class; a narrow pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, group in batch.groupby(batch["embedding"].map(len)):
                plan = cap_plan(int(dim), rows, least)
                for low in range(0, len(group), 128):
                    part = group.iloc[low : low + 128]
                    found = decode(unit_rows(np.array(part["embedding"].tolist(), "float64")), plan)
                    yield pd.DataFrame({"cid": part["cid"], "filters": found})

    return classes.select("cid", "embedding").mapInPandas(run, "cid long, filters array<long>")


def _shared_before(filters: list[np.ndarray], here: int) -> tuple[np.ndarray, np.ndarray]:
    """Membership of the rows in filters below ``here``, as (row, column) indices."""
    below = [f[f < here] for f in filters]
    owner = np.repeat(np.arange(len(below)), [len(f) for f in below])
    _, column = np.unique(np.concatenate(below) if below else np.empty(0, np.int64), return_inverse=True)
    return owner, column


def _new_links(unit: np.ndarray, filters: list[np.ndarray], here: int, left: np.ndarray, right: np.ndarray, least: float):
    """Boolean left x right matrix: close pairs whose smallest common filter is ``here``."""
    close = unit[left] @ unit[right].T >= least
    if not close.any():
        return close
    owner, column = _shared_before(filters, here)
    width = int(column.max()) + 1 if len(column) else 0
    for low in range(0, width, 2048):
        inside = (column >= low) & (column < low + 2048)
        member = np.zeros((len(unit), min(2048, width - low)), np.float32)
        member[owner[inside], column[inside] - low] = 1
        close &= member[left] @ member[right].T == 0
    return close


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row of each component of n rows linked by (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _compare(run: pd.DataFrame, least: float) -> pd.DataFrame:
    """(cid, links, root) of one large task: rows of one filter, or of two blocks of it."""
    unit = unit_rows(np.array(run["embedding"].tolist(), "float64"))
    filters, n, here = list(run["filters"]), len(run), int(run["filter"].iloc[0])
    side = run["side"].to_numpy()
    crossed = run["i"].iloc[0] != run["j"].iloc[0]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if crossed else left
    firsts, seconds = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low in range(0, len(left), BLOCK_ROWS):
        part = left[low : low + BLOCK_ROWS]
        close = _new_links(unit, filters, here, part, right, least)
        i, j = np.nonzero(close)
        i, j = part[i], right[j]
        once = np.full(len(i), True) if crossed else i < j
        firsts.append(i[once])
        seconds.append(j[once])
    return _told(run, np.concatenate(firsts), np.concatenate(seconds))


def _told(rows: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
    """(cid, links, root) of the rows that the links (i, j) touch."""
    links, copies, cid = np.zeros(len(rows), np.int64), rows["copies"].to_numpy("int64"), rows["cid"].to_numpy("int64")
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    out = pd.DataFrame({"cid": cid, "links": links, "root": cid[_roots(len(rows), i, j)]})
    return out[out["links"] > 0]


def _compare_small(rows: pd.DataFrame, sizes: np.ndarray, least: float) -> pd.DataFrame:
    """(cid, links, root) of many small tasks at once: ``sizes`` rows each, one filter each."""
    unit = unit_rows(np.array(rows["embedding"].tolist(), "float64"))
    ends = np.repeat(np.cumsum(sizes), sizes)
    later = ends - np.arange(len(rows)) - 1  # rows of the same task behind each row
    i = np.repeat(np.arange(len(rows)), later)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    close = np.concatenate([
        np.einsum("ij,ij->i", unit[i[k : k + 65_536]], unit[j[k : k + 65_536]]) >= least for k in range(0, len(i), 65_536)
    ] or [np.empty(0, bool)])
    i, j = i[close], j[close]
    sets, here = [set(f) for f in rows["filters"].map(np.ndarray.tolist)] if len(i) else [], rows["filter"].to_numpy()
    first = np.array([min(sets[a] & sets[b]) == here[a] for a, b in zip(i.tolist(), j.tolist(), strict=True)], bool)
    return _told(rows, i[first], j[first])


def _starts(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """First row of each task of sorted rows."""
    values = rows[keys].to_numpy("int64")
    return np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]).any(axis=1)]))


def _compare_tasks(rows: pd.DataFrame, starts: np.ndarray, least: float) -> Iterator[pd.DataFrame]:
    sizes = np.diff(np.append(starts, len(rows)))
    whole = (rows["i"].to_numpy() == rows["j"].to_numpy())[starts] if len(starts) else np.empty(0, bool)
    small = (sizes <= SMALL_TASK) & whole
    if small.any():
        part = rows[np.repeat(small, sizes)]
        lengths = part["embedding"].map(len).to_numpy()
        for n in np.unique(lengths):  # a task holds vectors of one length
            mine = lengths == n
            firsts = np.cumsum(sizes[small]) - sizes[small]
            yield _compare_small(part[mine], sizes[small][mine[firsts]], least)
    for at, n in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        yield _compare(rows.iloc[at : at + n], least)


def _links(classes: DataFrame, rows: int, least: float) -> DataFrame:
    """(cid, links, root) summed over nothing yet: one row per class and task in which it has links."""
    lists = cut(filter_lists(classes, rows, least))
    group = F.xxhash64("label", F.size("embedding"))
    owners = classes.select("cid", group.alias("group"))
    hits = cut(lists.join(owners, "cid").select("cid", "group", F.explode("filters").alias("filter")))
    sizes = hits.groupBy("group", "filter").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS)
    own = F.pmod(F.xxhash64("cid", "filter"), blocks)
    placed = hits.join(sizes, ["group", "filter"]).select(
        "cid", "group", "filter", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = placed.select(
        "cid", "group", "filter", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"))
    full = dealt.join(classes.select("cid", "embedding", "copies"), "cid").join(lists, "cid")
    keys = ["group", "filter", "i", "j"]
    sorted_ = full.repartition(tasks_for(classes), *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None  # rows of the last task so far, which may go on in the next batch
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            starts = _starts(rows, keys)
            yield from _compare_tasks(rows.iloc[: starts[-1]], starts[:-1], least)
            kept = rows.iloc[starts[-1] :]
        if kept is not None:
            yield from _compare_tasks(kept, np.zeros(1, np.int64), least)

    return sorted_.mapInPandas(run, "cid long, links long, root long")


def near_vectors(
    vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id) of every row: cosine of at least ``least`` links vectors of one label."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = cut(rows.where(sound).groupBy("label", "embedding").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first_id")).withColumn("cid", F.monotonically_increasing_id()))
    largest = classes.groupBy("label", F.size("embedding")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    found = cut(_links(classes, largest, least))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    edges = found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct()
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = connected_components(nodes, edges).select(F.col("id").alias("cid"), F.col("label").alias("component"))
    named = classes.select("cid", "first_id").join(labels, "cid")
    least_ids = named.groupBy("component").agg(F.min("first_id").alias("least"))
    told = labels.join(least_ids, "component").select("cid", F.lit(True).alias("linked"), "least")
    judged = classes.join(counts, "cid", "left").join(told, "cid", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("linked"), F.col("least")).otherwise(F.col("first_id")).alias("component_id"))
    linked = rows.where(sound).join(judged, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)
