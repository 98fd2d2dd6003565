"""Nearest neighbours in two or three dimensions by nested grids.

Repeated points are merged into one weighted point. Every cell of the nested
grids is counted, and each point searches from the smallest cell that holds at
least k rows: that cell's extent bounds its k-th distance. A search cell has
fewer than k rows in each of its children that search there, so a point is a
candidate for at most a constant number of searchers however dense its
surroundings are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.columns import number, squared_distance_sql
from orebed.functions.orderstats import aggregate_row
from orebed.operators.ranking import Knee, knee_chord
from orebed.operators.tiles import kth_distances
from orebed.session import cut_lineage, release


def distinct_points(df: DataFrame, cols: Sequence[str], key: str = "row_id") -> DataFrame:
    """Distinct coordinates x0..xd with their row count ``w`` and smallest key ``pid``."""
    coords = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    return (
        df.select(key, *coords).na.drop()
        .groupBy(*[f"x{i}" for i in range(len(cols))])
        .agg(F.count(F.lit(1)).alias("w"), F.min(key).alias("pid"))
    )


def box_columns(dims: int) -> list[Column]:
    """Aggregates for the tight box around points x0..xd."""
    return [F.expr(f"{f}(x{i}) AS {e}{i}") for i in range(dims) for f, e in (("min", "lo"), ("max", "hi"))]


def point_box_sql(dims: int) -> tuple[str, str]:
    """Squared distance from point x0..xd to the nearest and the farthest place of box lo/hi."""
    gap = [f"greatest(lo{i} - x{i}, x{i} - hi{i}, 0D)" for i in range(dims)]
    reach = [f"greatest(abs(x{i} - lo{i}), abs(x{i} - hi{i}))" for i in range(dims)]
    square = lambda terms: "(" + " + ".join(f"{t} * {t}" for t in terms) + ")"
    return square(gap), square(reach)


def cell_offsets(dims: int, skip_own: bool = False, half: bool = False) -> list[tuple[int, ...]]:
    """Offsets to the cells within the diagonal of a cell, below ceil(sqrt(d)) sides."""
    reach = math.ceil(math.sqrt(dims))
    found = [o for o in product(range(-reach, reach + 1), repeat=dims) if any(o) or not skip_own]
    return [o for o in found if o > (0,) * dims] if half else found


def offset_rows(dims: int, offsets: Sequence[tuple[int, ...]], base: str, name: str) -> str:
    """SQL generator of one cell struct per offset from the cell named ``base0..``."""
    cells = ", ".join(
        "named_struct(" + ", ".join(f"'{name}{i}', {base}{i} + {o[i]}" for i in range(dims)) + ")" for o in offsets
    )
    return f"inline(array({cells}))"


SLICE_POINTS = 1_000  # points of one cell that one slice of a join compares


def sliced_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join in which a cell of ``m`` right rows is split into slices of bounded size.

    ``left`` carries ``m``. Its few rows are copied once per slice, so that a
    cell that holds a large share of all points is compared by many tasks.
    """
    slices = f"CAST(greatest(ceil(m / {SLICE_POINTS}D), 1) AS INT)"
    sizes = left.select(*keys, "m").distinct()
    others = [c for c in right.columns if c not in keys]
    cut = right.join(sizes, list(keys)).selectExpr(
        *keys, *others, f"CAST(pmod(xxhash64({', '.join(others)}), {slices}) AS INT) AS slice"
    )
    spread = left.selectExpr("*", f"explode(sequence(0, {slices} - 1)) AS slice").drop("m")
    return spread.join(cut, [*keys, "slice"]).drop("slice")


FULL_DEPTH = 48   # finest level: doubles still resolve it
LEVELS_PER_PASS = 8


def _at_levels(table: DataFrame, dims: int, levels: Sequence[int]) -> DataFrame:
    """One copy per level with the cell c0.. that holds the finest cell g0.."""
    leveled = table.selectExpr("*", f"explode(array({', '.join(map(str, levels))})) AS level")
    return leveled.selectExpr("*", *[f"shiftright(g{i}, {FULL_DEPTH} - level) AS c{i}" for i in range(dims)])


def _nested_grids(grid: DataFrame, dims: int, k: int, n: int) -> list[tuple[DataFrame, DataFrame, range]]:
    """Counted cells in passes of a few levels: (points, cells, levels) per pass.

    The first pass goes down to cells of a few rows on average. Later passes
    split only the cells that are still overfull, together with the points of
    the cells around them, which their searches may reach.
    """
    axes = range(dims)
    cell = ["level", *[f"c{i}" for i in axes]]
    passes, active = [], grid
    start, end = 0, min(max(math.ceil(math.log2(max(n / k, 1)) / dims) + 2, 2), FULL_DEPTH)
    while True:
        levels = range(start, end + 1)
        # merge the points of one finest cell of this pass before copying to its levels
        fine = active.selectExpr(
            "w", *[f"x{i}" for i in axes],
            *[f"shiftleft(shiftright(g{i}, {FULL_DEPTH - end}), {FULL_DEPTH - end}) AS g{i}" for i in axes],
        ).groupBy(*[f"g{i}" for i in axes]).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("m"), *box_columns(dims))
        cells = cut_lineage(
            _at_levels(fine, dims, levels).groupBy(*cell).agg(
                F.sum("w").alias("w"), F.sum("m").alias("m"),
                *[F.expr(e) for i in axes for e in (f"min(lo{i}) AS lo{i}", f"max(hi{i}) AS hi{i}")],
            )
        )
        passes.append((active, cells, levels))
        # repeated points cannot be split: a cell of one place is never overfull
        spread = " OR ".join(f"hi{i} > lo{i}" for i in axes)
        overfull = cells.where(f"level = {end} AND w >= {k * 2**dims} AND ({spread})")
        if end == FULL_DEPTH or not overfull.limit(1).count():
            return passes
        near = overfull.selectExpr(offset_rows(dims, cell_offsets(dims), "c", "n")).distinct()
        keyed = active.selectExpr("*", *[f"shiftright(g{i}, {FULL_DEPTH - end}) AS n{i}" for i in axes])
        active = cut_lineage(keyed.join(near, [f"n{i}" for i in axes], "left_semi").select(*grid.columns))
        start, end = end + 1, min(end + LEVELS_PER_PASS, FULL_DEPTH)


def neighbor_table(df: DataFrame, cols: Sequence[str], k: int, key: str = "row_id") -> DataFrame:
    """The nearest distinct points of each distinct point until k rows are covered.

    Columns: ``pid``, ``w``, ``x0..``, ``other`` (neighbour pid), ``dist``,
    ``nn_rank`` (1 is the point itself) and ``covered`` (rows up to it).
    """
    dims = len(cols)
    axes = range(dims)
    pts = cut_lineage(distinct_points(df, cols, key))
    ends = aggregate_row(pts, [F.count(F.lit(1)), F.sum("w"), *[e for i in axes for e in (F.min(f"x{i}"), F.max(f"x{i}"))]])
    n, rows = ends[0], ends[1]
    if rows is None or rows < k:
        raise ValueError(f"{rows or 0} rows are fewer than k={k}")
    lows = ends[2::2]
    span = max(h - lo for lo, h in zip(lows, ends[3::2])) or 1.0
    xs, cs = ([f"{p}{i}" for i in axes] for p in "xc")
    cell = ["level", *cs]
    grid = pts.selectExpr("*", *[
        f"CAST(least(floor((x{i} - {number(lows[i])}) / {number(span)} * {2**FULL_DEPTH}), {2**FULL_DEPTH - 1}) AS BIGINT) AS g{i}"
        for i in axes
    ])
    passes = _nested_grids(grid, dims, k, n)
    diagonal = squared_distance_sql([f"hi{i}" for i in axes], [f"lo{i}" for i in axes])
    homes = None
    for active, cells, levels in passes:
        enough = cells.where(F.col("w") >= k).selectExpr(*cell, "m", f"{diagonal} * (1 + 1e-9D) AS bound")
        found = (
            _at_levels(active.select("pid", *xs, *[f"g{i}" for i in axes]), dims, levels).join(enough, cell)
            .groupBy("pid", *xs).agg(F.expr(f"max(struct(level, {', '.join(cs)}, m, bound)) AS home"))
        )
        homes = found if homes is None else homes.unionByName(found)
    if len(passes) > 1:
        homes = homes.groupBy("pid", *xs).agg(F.max("home").alias("home"))
    homes = cut_lineage(homes.select("pid", *xs, "home.*"))
    counted = passes[0][1]
    for _, cells, _ in passes[1:]:
        counted = counted.unionByName(cells)

    def compared(searches: DataFrame) -> DataFrame:
        """Distances within the bound between searchers and the points of their cells."""
        used = {r[0] for r in searches.select("level").distinct().collect()}
        candidates = None
        for active, _, levels in passes:
            hit = [v for v in levels if v in used]
            if hit:
                part = _at_levels(active, dims, hit).selectExpr(
                    *cell, "pid AS other", "w AS other_w", *[f"x{i} AS y{i}" for i in axes]
                )
                candidates = part if candidates is None else candidates.unionByName(part)
        d2 = squared_distance_sql(xs, [f"y{i}" for i in axes])
        pairs = sliced_join(searches, candidates, cell)
        # only keys and distances take part in the ranking
        return pairs.where(f"{d2} <= bound").selectExpr("pid", f"{d2} AS d2", "other", "other_w")

    nearest = Window.partitionBy("pid").orderBy("d2", "other")
    running = nearest.rowsBetween(Window.unboundedPreceding, 0)

    def first_rows(pairs: DataFrame) -> DataFrame:
        top = pairs.withColumn("nn_rank", F.row_number().over(nearest)).where(F.col("nn_rank") <= k)
        return top.withColumn("covered", F.sum("other_w").over(running)).where(f"covered - other_w < {k}")

    # the k-th distance inside the own cell bounds the search around it
    own = first_rows(compared(homes)).groupBy("pid").agg((F.max("d2") * (1 + 1e-9)).alias("bound"))
    near, _ = point_box_sql(dims)
    searchers = homes.drop("bound", "m").withColumnsRenamed({f"c{i}": f"h{i}" for i in axes}).join(own, "pid")
    searches = cut_lineage(
        searchers.selectExpr("pid", *xs, "level", "bound", offset_rows(dims, cell_offsets(dims), "h", "c"))
        .join(counted.drop("w"), cell).where(f"{near} <= bound")
        .select("pid", *xs, "bound", "m", *cell)
    )
    return first_rows(compared(searches)).join(pts, "pid").selectExpr(
        "pid", "w", *xs, "other", "sqrt(d2) AS dist", "nn_rank", "covered"
    )


def k_distance_points(df: DataFrame, cols: Sequence[str], ks: Sequence[int], key: str = "row_id") -> DataFrame:
    """Distinct points (``w`` and x0..) with the distance ``kd_<k>`` to their k-th row, themselves counted.

    Only distances come back from the tasks that compare points, no neighbours.
    """
    pts = cut_lineage(distinct_points(df, cols, key).drop("pid"))
    rows = aggregate_row(pts, [F.sum("w")])[0]
    if rows is None or rows < max(ks):
        raise ValueError(f"{rows or 0} rows are fewer than k={max(ks)}")
    found = kth_distances(pts, len(cols), ks)
    release(pts)
    return found


def k_distance(df: DataFrame, cols: Sequence[str], k: int, key: str = "row_id") -> DataFrame:
    """Distance of each row to its k-th nearest row, itself counted."""
    dims = range(len(cols))
    points = k_distance_points(df, cols, [k], key).select(*[f"x{i}" for i in dims], F.col(f"kd_{k}").alias("k_dist"))
    coords = df.select(key, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    return coords.join(points, [f"x{i}" for i in dims]).select(key, "k_dist")


def k_distance_knee(points: DataFrame, k: int) -> Knee:
    """Knee of the sorted k-distance curve of weighted points."""
    rows = points.select(F.col(f"kd_{k}").alias("kd"), "w")
    return knee_chord(rows, "kd", "w")
