"""Density-based clustering on a grid whose cells are no wider than the radius.

Points in one cell are always within the radius of each other. A cell with
enough rows therefore makes all its points core without any comparison, and
points of other cells, fewer than ``min_samples`` per cell, are the only ones
that count neighbours. Core cells are linked by comparing tight boxes first;
only undecided pairs are compared point by point, and large undecided pairs are
split into smaller boxes until they are decided or small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.functions.columns import number, squared_distance_sql
from orebed.functions.orderstats import aggregate_row
from orebed.operators.clustering import silhouette_exact
from orebed.operators.columns import distinct_ranks
from orebed.operators.components import connected_components
from orebed.operators.neighbors import (
    box_columns, cell_offsets, distinct_points, k_distance_knee, k_distance_points, offset_rows, point_box_sql,
    sliced_join,
)
from orebed.session import cut_lineage, passing_tables

NOISE = -1
COMPARED_PAIRS = 4_096  # point pairs compared directly for one pair of boxes
MAX_SPLITS = 50
SWEEP_VALUES = 3  # values of a sweep clustered at a time


def _names(prefix: str, dims: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(dims)]


def _around(table: DataFrame, dims: int, half: bool = False) -> DataFrame:
    """Copies of each row for the cells within reach of its own cell c0.., named n0.."""
    offsets = cell_offsets(dims, skip_own=True, half=half)
    return table.selectExpr("*", offset_rows(dims, offsets, "c", "n"))


def _box_gap(dims: int) -> tuple[str, str]:
    """Squared smallest and largest distance between boxes alo/ahi and blo/bhi."""
    gap = [f"greatest(blo{i} - ahi{i}, alo{i} - bhi{i}, 0D)" for i in range(dims)]
    reach = [f"greatest(abs(ahi{i} - blo{i}), abs(bhi{i} - alo{i}))" for i in range(dims)]
    return tuple("(" + " + ".join(f"{t} * {t}" for t in terms) + ")" for terms in (gap, reach))


def _within(dims: int, r2: float) -> str:
    return f"{squared_distance_sql(_names('x', dims), _names('y', dims))} <= {number(r2)}"


def _near_boxes(points: DataFrame, boxes: DataFrame, dims: int, r2: float) -> DataFrame:
    """Points joined with the boxes of surrounding cells that may hold a neighbour.

    ``whole`` tells that every place of the box is within the radius.
    """
    near, far = point_box_sql(dims)
    named = boxes.withColumnsRenamed({f"c{i}": f"n{i}" for i in range(dims)})
    return (
        _around(points, dims).join(named, _names("n", dims)).where(f"{near} <= {number(r2)}")
        .withColumn("whole", F.expr(f"{far} <= {number(r2)}"))
        .drop(*_names("lo", dims), *_names("hi", dims))
    )


def core_points(grid: DataFrame, dims: int, eps: float, min_samples: int) -> DataFrame:
    """Grid points with ``is_core``: at least ``min_samples`` rows within the radius, itself counted."""
    cell = _names("c", dims)
    cells = cut_lineage(
        grid.groupBy(*cell).agg(F.sum("w").alias("cw"), F.count(F.lit(1)).alias("m"), *box_columns(dims))
    )
    full = cells.where(F.col("cw") >= min_samples).select(*cell)
    dense = grid.join(full, cell, "left_semi").withColumn("is_core", F.lit(True))
    sparse = grid.join(cells.where(F.col("cw") < min_samples).select(*cell, F.col("cw").alias("own")), cell)
    r2 = eps * eps
    reachable = cut_lineage(_near_boxes(sparse.drop("w"), cells, dims, r2))
    sure = reachable.where("whole").groupBy("pid").agg(F.sum("cw").alias("rows"))
    # undecided boxes: compare with the points of the box
    other = grid.selectExpr(*[f"c{i} AS n{i}" for i in range(dims)], *[f"x{i} AS y{i}" for i in range(dims)], "w AS ow")
    compared = (
        sliced_join(reachable.where("not whole"), other, _names("n", dims)).where(_within(dims, r2))
        .groupBy("pid").agg(F.sum("ow").alias("rows"))
    )
    around = sure.unionByName(compared).groupBy("pid").agg(F.sum("rows").alias("around"))
    counted = sparse.join(around, "pid", "left").withColumn(
        "is_core", F.col("own") + F.coalesce("around", F.lit(0)) >= min_samples
    )
    return dense.unionByName(counted.select(*dense.columns))


def _linked_cells(core: DataFrame, dims: int, eps: float, side: float, lows: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Core cells (cid = smallest core key) and the pairs joined by a core pair within the radius."""
    axes = range(dims)
    cell, subs, ups = _names("c", dims), _names("s", dims), _names("p", dims)
    boxes = [f"{e}{i}" for i in axes for e in ("lo", "hi")]
    r2 = number(eps * eps)
    cells = cut_lineage(core.groupBy(*cell).agg(F.min("pid").alias("cid"), F.count(F.lit(1)).alias("n"), *box_columns(dims)))

    def as_side(table: DataFrame, s: str, keys: Sequence[str]) -> DataFrame:
        return table.selectExpr(f"cid AS {s}", f"n AS {s}n", *[f"{c} AS {s}{c}" for c in boxes], *keys)

    left = _around(as_side(cells, "a", cell), dims, half=True)
    right = as_side(cells, "b", [f"c{i} AS n{i}" for i in axes])
    near, far = _box_gap(dims)
    pairs = cut_lineage(
        left.join(right, _names("n", dims)).where(f"{near} <= {r2}")
        .selectExpr("a", "b", "an", "bn", f"{far} <= {r2} AS linked")
    )
    few = f"an * bn <= {COMPARED_PAIRS}"
    edges = pairs.where("linked").select("a", "b")
    members = core.join(cells.select(*cell, "cid"), cell).select("cid", *cell, *_names("x", dims))

    def compared(wanted: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Pairs of boxes with at least one pair of points within the radius."""
        pa = points.selectExpr("cid AS a", *[f"{k} AS a{k}" for k in keys], *_names("x", dims))
        pb = points.selectExpr("cid AS b", *[f"{k} AS b{k}" for k in keys], *[f"x{i} AS y{i}" for i in axes])
        return (
            wanted.join(pa, ["a", *[f"a{k}" for k in keys]]).join(pb, ["b", *[f"b{k}" for k in keys]])
            .where(_within(dims, eps * eps)).select("a", "b").distinct()
        )

    undecided = pairs.where("not linked")
    edges = edges.unionByName(compared(undecided.where(few).select("a", "b"), members, []))
    zero = [f"CAST(0 AS BIGINT) AS {s}{p}" for s in "ab" for p in ups]
    state = undecided.where(f"not ({few})").selectExpr("a", "b", *zero)
    level = 0
    while state.limit(1).count():
        level += 1
        if level > MAX_SPLITS:
            raise RuntimeError("boxes did not separate")
        # boxes of the next subdivision, each with the box it is a part of
        used = state.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        step = number(side / 2**level)
        points = members.join(used, "cid", "left_semi").selectExpr(
            "cid", *_names("x", dims),
            *[f"CAST(floor((x{i} - {number(lows[i])}) / {step}) - c{i} * {2**level} AS BIGINT) AS s{i}" for i in axes],
        )
        parts = points.groupBy("cid", *subs).agg(F.count(F.lit(1)).alias("n"), *box_columns(dims))
        halves = {
            s: as_side(parts, s, [f"s{i} AS {s}s{i}" for i in axes] + [f"shiftright(s{i}, 1) AS {s}p{i}" for i in axes])
            for s in "ab"
        }
        tested = cut_lineage(
            state.join(halves["a"], ["a", *[f"a{p}" for p in ups]]).join(halves["b"], ["b", *[f"b{p}" for p in ups]])
            .where(f"{near} <= {r2}")
            .selectExpr("a", "b", "an", "bn", *[f"{s}s{i}" for s in "ab" for i in axes], f"{far} <= {r2} AS linked")
        )
        found = tested.where("linked").select("a", "b").distinct()
        unclear = tested.join(found, ["a", "b"], "left_anti")
        hit = cut_lineage(found.unionByName(compared(unclear.where(few).drop("an", "bn", "linked"), points, subs)))
        edges = edges.unionByName(hit)
        state = cut_lineage(
            unclear.where(f"not ({few})").join(hit, ["a", "b"], "left_anti")
            .selectExpr("a", "b", *[f"{s}s{i} AS {s}p{i}" for s in "ab" for i in axes])
        )
    return cells, edges


def dbscan(df: DataFrame, cols: Sequence[str], eps: float, min_samples: int, key: str = "row_id") -> DataFrame:
    """(key, label, is_core, is_noise): dense regions numbered by their smallest core key, noise -1.

    A border row near several regions takes the one with the smallest number,
    so the result does not depend on row order.
    """
    dims = len(cols)
    cell = _names("c", dims)
    pts = cut_lineage(distinct_points(df, cols, key))
    lows = aggregate_row(pts, [F.min(f"x{i}") for i in range(dims)])
    lows = [v if v is not None else 0.0 for v in lows]
    # slightly below eps / sqrt(d), so that rounding cannot push a cell mate out of reach
    side = eps / math.sqrt(dims) * (1 - 1e-9)
    grid = pts.selectExpr("*", *[
        f"CAST(floor((x{i} - {number(lows[i])}) / {number(side)}) AS BIGINT) AS c{i}" for i in range(dims)
    ])
    points = cut_lineage(core_points(grid, dims, eps, min_samples))
    core = points.where("is_core")
    cells, edges = _linked_cells(core, dims, eps, side, lows)
    comp = connected_components(cells.select(F.col("cid").alias("id")), edges)
    ranks = distinct_ranks(comp, "label").select(F.col("value").alias("label"), (F.col("rank") - 1).alias("region"))
    numbered = cut_lineage(
        cells.join(comp.withColumnRenamed("id", "cid"), "cid").join(ranks, "label").drop("label")
        .withColumnRenamed("n", "m")
    )
    own = numbered.select(*cell, F.col("region").alias("own"))
    inside = points.join(own, cell).select("pid", F.col("own").alias("region"))
    # rows that are not core: any region with a core point in reach
    r2 = eps * eps
    loose = points.where("not is_core").select("pid", *cell, *_names("x", dims))
    reachable = cut_lineage(_near_boxes(loose, numbered, dims, r2))
    other = core.selectExpr(*[f"c{i} AS n{i}" for i in range(dims)], *[f"x{i} AS y{i}" for i in range(dims)])
    touched = sliced_join(reachable.where("not whole"), other, _names("n", dims)).where(_within(dims, r2))
    region = (
        inside.unionByName(reachable.where("whole").select("pid", "region"))
        .unionByName(touched.select("pid", "region"))
        .groupBy("pid").agg(F.min("region").alias("region"))
    )
    labelled = points.join(region, "pid", "left").select(
        *_names("x", dims), "is_core", F.coalesce("region", F.lit(NOISE)).cast("bigint").alias("label")
    )
    rows = df.select(key, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    return rows.join(labelled, _names("x", dims)).select(
        key, "label", "is_core", (F.col("label") == NOISE).cast("int").alias("is_noise")
    )


def linkage_components(df: DataFrame, cols: Sequence[str], t: float, key: str = "row_id") -> DataFrame:
    """Single-linkage cut at distance ``t``: rows chained by steps of at most ``t``."""
    return dbscan(df, cols, t, 1, key).select(key, "label")


@dataclass(frozen=True)
class DensityParams:
    min_samples: int
    eps: float
    knee_rank: int


def dbscan_params(df: DataFrame, cols: Sequence[str], key: str = "row_id") -> DensityParams:
    """``min_samples`` = round(ln n) over the rows with coordinates, and ``eps`` at the knee of the k-distance curve."""
    min_samples = max(1, round(math.log(max(1, df.select(*cols).na.drop("any").count()))))
    knee = k_distance_knee(k_distance_points(df, cols, [min_samples], key), min_samples)
    return DensityParams(min_samples, knee.value, knee.rank)


def dbscan_sweep(
    df: DataFrame, cols: Sequence[str], values: Sequence[int], key: str = "row_id", sample: int | None = None, seed: int = 42
) -> DataFrame:
    """Knee radius, regions, noise share and silhouette of clustered rows per ``min_samples``.

    One neighbour search serves every value. A few values at a time are clustered side by side,
    as many of their jobs are short; the tables of a value go when it is done.
    """
    with passing_tables():
        points = k_distance_points(df, cols, list(values), key)
        radii = [k_distance_knee(points, m).value for m in values]

    def measured(m: int, eps: float) -> tuple:
        with passing_tables():
            found = cut_lineage(dbscan(df, cols, eps, m, key))
            n, regions, noise = aggregate_row(found, [
                F.count(F.lit(1)), F.max("label") + 1, F.sum("is_noise"),
            ])
            quality = None
            if regions >= 2 and n - noise > regions:
                clustered = df.select(key, *cols).join(found.where("is_noise = 0").select(key, "label"), key)
                quality = silhouette_exact(clustered, cols, "label", sample, seed, key).first()["silhouette"]
            return m, eps, regions, 100.0 * noise / n, quality

    with ThreadPoolExecutor(SWEEP_VALUES) as pool:
        rows = list(pool.map(measured, values, radii))
    return df.sparkSession.createDataFrame(
        rows, "min_samples int, eps double, regions bigint, noise_pct double, silhouette double"
    )
