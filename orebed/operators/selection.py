"""Feature selection."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.functions.columns import digamma, right_closed_bin
from orebed.functions.orderstats import aggregate_row, exact_quantiles
from orebed.functions.stats import digamma_values
from orebed.operators.correlation import pair_correlations
from orebed.operators.sampling import sample_exact
from orebed.session import cut_lineage


def redundant_columns(
    pairs: Sequence[tuple[str, str, float | None]], thr: float, priority: Sequence[str], target: str | None = None
) -> list[str]:
    """Columns to drop so that no kept pair is correlated above the threshold.

    Pairs are settled from the strongest down; a pair that already lost a
    member is settled. The member of lower priority goes, the second one when
    they are equal, and never the target.
    """
    place = {c: i for i, c in enumerate(priority)}
    dropped: list[str] = []
    strong = sorted(
        (p for p in pairs if p[2] is not None and abs(p[2]) > thr), key=lambda p: -abs(p[2])
    )
    for a, b, _ in strong:
        if a in dropped or b in dropped:
            continue
        worse_a = place.get(a, len(place)) > place.get(b, len(place))
        if target in (a, b):
            worse_a = b == target
        dropped.append(a if worse_a else b)
    return dropped


def prune_correlated(
    df: DataFrame, cols: Sequence[str], thr: float = 0.85, priority: Sequence[str] = (), target: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Drop redundant columns; the p x p correlations come from one Spark pass."""
    lost = redundant_columns(pair_correlations(df, cols), thr, priority, target)
    return df.drop(*lost), lost


#: rows in one value-range slice of a feature, at most about
SLICE_ROWS = 200_000
#: values that a task holds before it sends them on, over all features
HELD_VALUES = 4_000_000
PIECE_SCHEMA = "f int, s int, y string, n long, xs array<long>, cs array<long>"
AROUND = pa.schema([
    ("f", pa.int32()), ("s", pa.int32()), ("i", pa.int32()), ("whole", pa.bool_()), ("w", pa.float64()), ("psi", pa.float64()),
    ("c", pa.int64()), ("lo", pa.int64()), ("lo_s", pa.int32()), ("hi", pa.int64()), ("hi_s", pa.int32()),
    ("size", pa.int64()), ("vs", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64())),
])
AROUND_SCHEMA = (
    "f int, s int, i int, whole boolean, w double, psi double, c long, lo long, lo_s int, hi long, hi_s int, "
    "size long, vs array<long>, ns array<long>"
)
RANK_SCHEMA = "f int, s int, i int, c long, t int, side int, below long"


def _class_text(df: DataFrame, target: str) -> Column:
    """The class as text, both zeros alike."""
    y = F.col(target)
    if isinstance(df.schema[target].dataType, (T.FloatType, T.DoubleType)):
        y = F.when(y == 0, F.lit(0.0).cast(df.schema[target].dataType)).otherwise(y)
    return y.cast("string")


def _merged(order: Sequence[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of the key arrays (the first one leads) in sorted order, with their summed counts."""
    at = np.lexsort(order[::-1])
    keys = [o[at] for o in order]
    if not len(at):
        return keys, counts
    new = np.ones(len(at), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(counts[at], first)


def _piece_fold(cuts: Sequence[np.ndarray], held: int):
    """Fold of (y, x0, x1, ...) batches into sorted, merged values per (feature, slice, class)."""

    def pieces(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        classes = table.column("y").combine_chunks().dictionary_encode()
        if isinstance(classes, pa.ChunkedArray):
            classes = classes.combine_chunks()
        code = classes.indices.to_numpy(zero_copy_only=False)
        for f, edges in enumerate(cuts):
            column = table.column(f"x{f}")
            there = column.is_valid().to_numpy()
            x = column.drop_null().to_numpy()
            if not len(x):
                continue
            (y, x), c = _merged([code[there], x], np.ones(len(x), "int64"))
            s = np.searchsorted(edges, x, "right")
            new = np.ones(len(x), bool)
            new[1:] = (y[1:] != y[:-1]) | (s[1:] != s[:-1])
            first = np.flatnonzero(new)
            bounds = pa.array(np.append(first, len(x)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(first), f, "int32")), pa.array(s[first].astype("int32")),
                classes.dictionary.take(pa.array(y[first])).cast(pa.string()), pa.array(np.add.reduceat(c, first)),
                pa.ListArray.from_arrays(bounds, pa.array(x)), pa.ListArray.from_arrays(bounds, pa.array(c)),
            ], ["f", "s", "y", "n", "xs", "cs"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows >= held:
                yield from pieces(kept)
                kept, rows = [], 0
        if kept:
            yield from pieces(kept)

    return fold


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists of a column, and the length of each."""
    return pc.list_flatten(lists).to_numpy(), pc.list_value_length(lists).to_numpy()


def _kth_distance(y: np.ndarray, x: np.ndarray, c: np.ndarray, of: np.ndarray, need: np.ndarray, k: int) -> np.ndarray:
    """Distance from each place in ``of`` to its ``need``-th nearest same-class point, over values sorted by (y, x)."""
    far = np.iinfo("int64").max
    d = np.zeros(len(of), "int64")
    rest = np.flatnonzero(need > 0)
    left, right, got = of - 1, of + 1, np.zeros(len(of), "int64")
    for _ in range(k):
        at, lo, hi = of[rest], left[rest], right[rest]
        low, high = np.maximum(lo, 0), np.minimum(hi, len(x) - 1)
        below = np.where((lo >= 0) & (y[low] == y[at]), x[at] - x[low], far)
        above = np.where((hi < len(x)) & (y[high] == y[at]), x[high] - x[at], far)
        nearer = below <= above
        got[rest] += c[np.where(nearer, low, high)]
        d[rest] = np.where(nearer, below, above)
        left[rest] -= nearer
        right[rest] += ~nearer
        rest = rest[got[rest] < need[rest]]
    return d


def _around_fold(cuts: Sequence[np.ndarray], k: int):
    """Sums over the points of a slice, the points whose radius leaves it, and the merged values of the slice."""

    def fold(key: tuple, pieces: pa.Table, info: pa.Table) -> pa.Table:
        f, s = (v.as_py() for v in key)
        n_y = info["n_y"].to_numpy()
        xs, sizes = _flat(pieces["xs"])
        of = pc.index_in(pieces["y"], info["y"].combine_chunks()).to_numpy()
        (y, x), c = _merged([np.repeat(of, sizes), xs], _flat(pieces["cs"])[0])
        held = n_y[y] > 1
        y, x, c = y[held], x[held], c[held]
        (vs,), ns = _merged([x], c)
        upto = np.concatenate([[0], np.cumsum(ns)])

        # values beyond the borders stand beside the own ones, with their counts
        around = [(_flat(info[v]), _flat(info[n])[0]) for v, n in (("bx", "bc"), ("ax", "ac"))]
        all_y = np.concatenate([y] + [np.repeat(np.arange(info.num_rows), sizes) for (_, sizes), _ in around])
        all_x = np.concatenate([x] + [v for (v, _), _ in around])
        all_c = np.concatenate([c] + [n for _, n in around])
        at = np.lexsort((all_x, all_y))
        place = np.empty(len(at), "int64")
        place[at] = np.arange(len(at))
        kk = np.minimum(k, n_y[y] - 1)
        d = _kth_distance(all_y[at], all_x[at], all_c[at], place[: len(x)], kk - (c - 1), k)

        lo, hi = x - d, x + d
        seen = np.where(d > 0, upto[np.searchsorted(vs, hi, "left")] - upto[np.searchsorted(vs, lo, "right")],
                        ns[np.searchsorted(vs, x)] if len(x) else 0)
        leaves = np.zeros(len(x), bool)
        if s > 0:
            leaves |= (d > 0) & (lo < cuts[f][s - 1] - 1)
        if s < len(cuts[f]):
            leaves |= (d > 0) & (hi > cuts[f][s])
        psi = c * (digamma_values(kk) - digamma_values(n_y[y]))
        inside = ~leaves
        done = psi.sum() - (c[inside] * digamma_values(seen[inside])).sum()
        out = np.flatnonzero(leaves)
        # the first row is that of the slice, the others are points that ask other slices
        first = np.arange(len(out) + 1) == 0
        lo, hi = np.append(0, lo[out]), np.append(0, hi[out])
        found = {
            "f": np.full(len(first), f), "s": np.full(len(first), s), "i": np.arange(len(first)), "whole": first,
            "w": first * float(c.sum()), "psi": first * done, "c": np.append(0, c[out]),
            "lo": lo, "lo_s": np.searchsorted(cuts[f], lo, "right"), "hi": hi, "hi_s": np.searchsorted(cuts[f], hi, "right"),
            "size": first * c.sum(),
        }
        for name, values in (("vs", vs), ("ns", ns)):
            bounds = np.full(len(first) + 1, len(values))
            bounds[0] = 0
            found[name] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
        return pa.table(found).cast(AROUND)

    return fold


def _rank_fold(ends: pa.Table, totals: pa.Table) -> pa.Table:
    """Points of a slice below each upper end, and up to each lower end."""
    vs, ns = _flat(totals["vs"])[0], _flat(totals["ns"])[0]
    upto = np.concatenate([[0], np.cumsum(ns)]).astype("int64")
    at, upper = ends["at"].to_numpy(), ends["side"].to_numpy() > 0
    place = np.where(upper, np.searchsorted(vs, at, "left"), np.searchsorted(vs, at, "right"))
    return ends.drop_columns(["at"]).append_column("below", pa.array(upto[place]))


def _carried(pieces: DataFrame, k: int) -> DataFrame:
    """Per (feature, slice, class): its size over all slices and the k nearest values beyond each border."""
    zipped = F.arrays_zip(F.col("xs").alias("x"), F.col("cs").alias("c"))
    ends = {"low": F.slice(zipped, 1, k), "high": F.slice(zipped, F.greatest(F.size("xs") - k + 1, F.lit(1)), k)}
    at = ["f", "s", "y"]
    near = None
    for side, values in ends.items():
        merged = pieces.select(*at, F.explode(values).alias("v")).groupBy(*at, "v.x").agg(F.sum("v.c").alias("c"))
        w = Window.partitionBy(*at).orderBy("x" if side == "low" else F.desc("x"))
        found = merged.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy(*at).agg(
            F.collect_list(F.struct("x", "c")).alias(side))
        near = found if near is None else near.join(found, at)
    sizes = pieces.groupBy(*at).agg(F.sum("n").alias("n"))
    order = Window.partitionBy("f", "y").orderBy("s")
    # each slice of a class holds a value, so the k nearest lie in the k nearest of its slices
    before = F.flatten(F.collect_list("high").over(order.rowsBetween(-k, -1)))
    after = F.flatten(F.collect_list("low").over(order.rowsBetween(1, k)))
    # the keys get names of their own, since the pieces meet this table again
    return near.join(sizes, at).select(
        *[F.col(c).alias(c) for c in at], F.sum("n").over(Window.partitionBy("f", "y")).alias("n_y"),
        F.slice(F.reverse(F.array_sort(before)), 1, k).alias("b"), F.slice(F.array_sort(after), 1, k).alias("a"),
    ).select(*at, "n_y", F.col("b.x").alias("bx"), F.col("b.c").alias("bc"), F.col("a.x").alias("ax"), F.col("a.c").alias("ac"))


def mutual_info_knn(
    df: DataFrame, features: Sequence[str], target: str, k: int = 5, sample: int | None = None,
    seed: int = 42, key: str = "row_id", slices: int | None = None,
) -> DataFrame:
    """Nearest-neighbour mutual information of continuous features and a class (Ross 2014).

    In one dimension neighbours are found by sorting. Each feature is shifted to
    its minimum and scaled by a power of ten to whole numbers of up to 50 bits,
    so that a value plus a radius is exact and the unit does not matter. All rows
    are read unless a ``sample`` is asked for.

    Each feature is range-split into slices at approximate quantiles (``slices``,
    by default one per ``SLICE_ROWS`` rows). Map tasks merge equal (feature, class,
    value) rows and send them on as sorted arrays, once per row and feature; a
    slice is one group of numpy searches. The k nearest same-class values beyond
    each border are carried in, and only points whose radius leaves the slice ask
    other slices for their ranks. The result does not depend on the slices.
    """
    features = list(features)
    rows = df.select(key, target, *features).where(F.col(target).isNotNull())
    if sample is not None:
        rows = sample_exact(rows, sample, seed, key)
    n, *ends = aggregate_row(rows, [F.count(F.lit(1))] + [f(F.col(c).cast("double")) for c in features for f in (F.min, F.max)])
    numbers = []
    for i, c in enumerate(features):
        lo, hi = ends[2 * i : 2 * i + 2]
        low = lo if lo is not None else 0.0
        wide = (hi - lo) if lo is not None and hi > lo else 1.0
        scale = 10.0 ** math.floor(math.log10(2.0**50 / wide))
        numbers.append(F.round((F.col(c).cast("double") - F.lit(low)) * F.lit(scale)).cast("bigint").alias(f"x{i}"))
    points = rows.select(_class_text(df, target).alias("y"), *numbers)
    if slices is None:
        slices = max(1, math.ceil(n / SLICE_ROWS))
    cuts = [np.zeros(0, "int64") for _ in features]
    if slices > 1:
        probs = [i / slices for i in range(1, slices)]
        found = aggregate_row(points, [F.percentile_approx(f"x{i}", probs, 10000) for i in range(len(features))])
        cuts = [np.array(sorted(v or []), "int64") for v in found]
    held = max(10_000, HELD_VALUES // max(len(features), 1))
    pieces = cut_lineage(points.mapInArrow(_piece_fold(cuts, held), PIECE_SCHEMA))
    around = cut_lineage(
        pieces.select("f", "s", "y", "xs", "cs").groupBy("f", "s")
        .cogroup(_carried(pieces, k).groupBy("f", "s")).applyInArrow(_around_fold(cuts, k), AROUND_SCHEMA))
    done = around.where("whole")
    sums = done.groupBy("f").agg(F.sum("w").alias("w"), F.sum("psi").alias("psi"))
    if slices > 1:
        # ranks of the ends that points asked for: inside their slice, plus all lower slices
        asked = around.where("not whole").select("f", "s", "i", "c", F.explode(F.array(
            F.struct(F.col("hi_s").alias("t"), F.col("hi").alias("at"), F.lit(1).alias("side")),
            F.struct(F.col("lo_s").alias("t"), F.col("lo").alias("at"), F.lit(-1).alias("side")),
        )).alias("e")).select("f", "s", "i", "c", "e.t", "e.at", "e.side")
        # an end may lie in a slice without points
        lower = Window.partitionBy("f").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
        offsets = done.select("f", F.col("s").alias("t"), "size").unionByName(
            asked.select("f", "t").distinct().withColumn("size", F.lit(0).cast("long"))
        ).groupBy("f", "t").agg(F.sum("size").alias("size")).select(
            "f", "t", F.coalesce(F.sum("size").over(lower), F.lit(0)).alias("offset"))
        ranks = asked.groupBy("f", "t").cogroup(
            done.select(F.col("f").alias("f"), F.col("s").alias("t"), "vs", "ns").groupBy("f", "t")
        ).applyInArrow(_rank_fold, RANK_SCHEMA)
        spans = ranks.join(offsets, ["f", "t"]).groupBy("f", "s", "i").agg(
            F.first("c").alias("c"), F.sum((F.col("below") + F.col("offset")) * F.col("side")).alias("m"))
        left = spans.groupBy("f").agg(F.sum(F.col("c") * digamma(F.col("m"))).alias("out"))
        sums = sums.join(left, "f", "left").select("f", "w", (F.col("psi") - F.coalesce("out", F.lit(0.0))).alias("psi"))
    names = F.array(*[F.lit(c) for c in features])
    return sums.where("w > 0").select(
        names[F.col("f")].alias("feature"),
        F.greatest(F.lit(0.0), digamma(F.col("w")) + F.col("psi") / F.col("w")).alias("mi"),
    ).orderBy(F.desc("mi"), "feature")


def mutual_info_binned(df: DataFrame, features: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Plug-in mutual information of quantile-binned features and a class, on all rows."""
    edges = exact_quantiles(df, features, [i / bins for i in range(bins + 1)])
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            right_closed_bin(
                F.col(c), sorted(set(edges[c])), range(len(set(edges[c])) - 1) , lowest=True
            ).cast("int").alias("bin"),
        )
        for c in features if edges[c][0] is not None and len(set(edges[c])) > 1
    ]
    joint = (
        df.where(F.col(target).isNotNull())
        .select(F.col(target).alias("y"), F.explode(F.array(*cells)).alias("c"))
        .where("c.bin is not null")
        .groupBy("c.feature", "c.bin", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    # the contingency table has bins x classes rows per feature
    f, fb, fy = (Window.partitionBy(*p) for p in (["feature"], ["feature", "bin"], ["feature", "y"]))
    n, total = F.col("n"), F.sum("n").over(f)
    share = n / total * F.log(n * total / (F.sum("n").over(fb) * F.sum("n").over(fy)))
    return (
        joint.withColumn("t", share).groupBy("feature").agg(F.sum("t").alias("mi"))
        .orderBy(F.desc("mi"), "feature")
    )


def hybrid_subset(
    core: Sequence[str], ranked: Sequence[str], corr: Mapping[tuple[str, str], float | None],
    size: int = 12, guard: float = 0.70,
) -> list[str]:
    """Core features, then ranked ones that are not redundant with those chosen."""
    chosen = list(core)
    for f in ranked:
        if len(chosen) >= size:
            break
        ties = [corr.get((f, c), corr.get((c, f))) for c in chosen]
        if f not in chosen and not any(r is not None and abs(r) > guard for r in ties):
            chosen.append(f)
    return chosen


def class_entropy(df: DataFrame, target: str) -> float:
    """Entropy of the class in nats, the upper bound of any mutual information."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).count()
    h = aggregate_row(counts, [F.log(F.sum("count")) - F.sum(F.col("count") * F.log("count")) / F.sum("count")])
    return h[0]
