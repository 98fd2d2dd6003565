"""Centroid and divisive clustering, cluster quality and agreement."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.columns import number, quoted, squared_distance_sql
from orebed.functions.stats import pairs_of
from orebed.operators.distances import cluster_distances
from orebed.operators.ranking import winner_by
from orebed.operators.sampling import sample_exact
from orebed.session import cut_lineage, release

SILHOUETTE_BLOCK = 2_000  # rows on each side of one block of distances
SILHOUETTE_TILE = 100  # rows compared with a block at once: their distances stay in the cache
SILHOUETTE_GROUPS = 24  # groups that rows are dealt into: a row is sent this often to each side
DIRECT_ROWS = 50_000  # rows, and
DIRECT_SUMS = 2_000_000  # rows times clusters, up to which all pairs are compared in the plane, too
GROUP_ROWS = 1_000_000  # rows of a group, at most about; beyond that there are more groups


@dataclass(frozen=True)
class Centers:
    cols: tuple[str, ...]
    points: tuple[tuple[float, ...], ...]
    cost: float


def _vectors(df: DataFrame, cols: Sequence[str], *keep: str) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df).select(*keep, "features")


def _initial_centers(df: DataFrame, cols: Sequence[str], runs: Sequence[tuple[int, int]], key: str) -> dict[int, np.ndarray]:
    """Start of each (k, seed) run: the k rows with the smallest hash of (key, seed), whatever the partitions."""
    picks = None
    for run, (k, seed) in enumerate(runs):
        complete = F.lit(True)
        for c in cols:
            complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c))
        ranked = df.where(complete).select(
            F.lit(run).alias("run"), F.xxhash64(F.col(key), F.lit(seed)).alias("h"), F.col(key).alias("_key"),
            *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]).orderBy("h", "_key").limit(k)
        picks = ranked if picks is None else picks.unionByName(ranked)
    starts: dict[int, list] = {}
    for row in picks.collect():  # at most the sum of k over the runs
        starts.setdefault(row["run"], []).append([row[f"_x{i}"] for i in range(len(cols))])
    return {run: np.asarray(points, float) for run, points in starts.items()}


def _lloyd_step(cols: Sequence[str], centers: dict[int, np.ndarray]):
    """Partial sums, counts and costs per (run, centre) of one batch of rows."""
    names = [f"s{i}" for i in range(len(cols))]

    def run(batches):
        for batch in batches:
            x = batch[list(cols)].to_numpy(float)
            x = x[~np.isnan(x).any(axis=1)]
            out = []
            for r, c in centers.items():
                d2 = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]
                near = np.argmin(d2, axis=1)
                cost = np.maximum(d2[np.arange(len(x)), near], 0.0)
                frame = pd.DataFrame({"run": r, "center": np.arange(len(c)),
                                      "n": np.bincount(near, minlength=len(c)),
                                      "cost": np.bincount(near, cost, minlength=len(c))})
                for i, name in enumerate(names):
                    frame[name] = np.bincount(near, x[:, i], minlength=len(c))
                out.append(frame)
            if out:
                yield pd.concat(out, ignore_index=True)

    schema = "run int, center int, n long, cost double, " + ", ".join(f"{n} double" for n in names)
    return run, schema, names


def kmeans_runs(
    df: DataFrame, cols: Sequence[str], runs: Sequence[tuple[int, int]], key: str = "row_id",
    max_iter: int = 20, tol: float = 1e-4,
) -> list[Centers]:
    """Lloyd's k-means for many (k, seed) runs at once: one pass over the rows per iteration serves all.

    Rows with a null coordinate take no part. A centre that loses all its rows keeps its place.
    Runs stop together when no centre of any run moves by more than ``tol`` times the spread of
    the data, or after ``max_iter`` passes.
    """
    data = cut_lineage(df.select(key, *[F.col(c).cast("double").alias(c) for c in cols]))
    centers = _initial_centers(data, cols, runs, key)
    ends = data.agg(*[f(c) for c in cols for f in (F.min, F.max)]).first()
    spread = max([1e-300] + [ends[2 * i + 1] - ends[2 * i] for i in range(len(cols)) if ends[2 * i] is not None])
    costs = {r: float("inf") for r in centers}
    for _ in range(max_iter + 1):
        step, schema, names = _lloyd_step(cols, centers)
        sums = data.mapInPandas(step, schema).groupBy("run", "center").agg(
            F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(n).alias(n) for n in names]).collect()
        moved, fresh = 0.0, {r: c.copy() for r, c in centers.items()}
        costs = {r: 0.0 for r in centers}
        for row in sums:  # one row per (run, centre)
            costs[row["run"]] += row["cost"]
            if row["n"]:
                point = np.array([row[n] for n in names]) / row["n"]
                moved = max(moved, float(np.abs(point - centers[row["run"]][row["center"]]).max()))
                fresh[row["run"]][row["center"]] = point
        if moved <= tol * spread:
            break
        centers = fresh
    release(data)
    found = []
    for run in range(len(runs)):
        points = sorted(tuple(float(x) for x in p) for p in centers.get(run, np.zeros((0, len(cols)))))
        found.append(Centers(tuple(cols), tuple(points), costs.get(run, 0.0)))
    return found


def kmeans_fit(
    df: DataFrame, cols: Sequence[str], k: int, n_init: int = 10, seed: int = 42, max_iter: int = 20,
    key: str = "row_id",
) -> Centers:
    """Best of ``n_init`` k-means starts, all fitted in the same passes; centers are sorted so that labels are stable."""
    fits = kmeans_runs(df, cols, [(k, seed + i) for i in range(n_init)], key, max_iter)
    return min(fits, key=lambda f: f.cost)


def assign_nearest(df: DataFrame, centers: Centers, out: str = "cluster", distance: str | None = None) -> DataFrame:
    """Label of the nearest center, the smallest label on ties; one projection, no join."""
    cols = [f"CAST({quoted(c)} AS DOUBLE)" for c in centers.cols]
    ranked = ", ".join(
        f"named_struct('d', {squared_distance_sql(cols, [number(x) for x in p])}, 'i', {i})"
        for i, p in enumerate(centers.points)
    )
    df = df.withColumn("_best", F.expr(f"array_min(array({ranked}))"))
    found = {out: F.col("_best.i"), **({distance: F.col("_best.d")} if distance else {})}
    return df.withColumns(found).drop("_best")


def inertia(df: DataFrame, centers: Centers) -> DataFrame:
    """Rows and summed squared distance per cluster."""
    return assign_nearest(df, centers, distance="_d").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_d").alias("inertia")
    )


def hierarchical_bisect(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, out: str = "segment") -> DataFrame:
    """Divisive hierarchy cut at ``k`` leaves, fitted on all rows.

    Labels are the model's own, along the tree, numbered by the leaves' sorted centres.
    """
    model = BisectingKMeans(k=k, seed=seed, predictionCol="_leaf").fit(_vectors(df, cols))
    centers = [tuple(float(x) for x in c) for c in model.clusterCenters()]
    order = sorted(range(len(centers)), key=centers.__getitem__)
    number_of = F.array(*[F.lit(order.index(leaf)) for leaf in range(len(centers))])
    return model.transform(_vectors(df, cols, *df.columns)).withColumn(out, F.get(number_of, F.col("_leaf"))).select(
        *df.columns, out)


def _distance_sums(rows: DataFrame, names: list[str], key: str, groups: int) -> DataFrame:
    """(key, other, total): summed distance of each row to the rows of each cluster.

    Groups of rows meet in separate tasks, which hold two groups and one block of
    distances, and give back one number per row and cluster, so no pair is ever
    emitted. The number of groups does not grow with the rows until a group would
    exceed ``GROUP_ROWS``, so neither does the number of times a row is sent.
    """
    own = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")  # of one type on both sides, so that equal groups meet
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    # named anew on both sides: columns that a cogroup shares with itself may be pruned from one of them
    held = [F.col(c).alias(c) for c in (key, "_label", *names)]
    dealt = lambda side: side.repartition(groups * groups, "_g", "_h").groupBy("_g", "_h")
    left = dealt(rows.select(*held, own.alias("_g"), every.alias("_h")))
    right = dealt(rows.select(*held, own.alias("_h"), every.alias("_g")))
    block, tile = SILHOUETTE_BLOCK, SILHOUETTE_TILE

    def meet(mine: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        x, y = mine[names].to_numpy(dtype=float), held[names].to_numpy(dtype=float)
        labels, code = np.unique(held["_label"].to_numpy(), return_inverse=True)
        order = np.argsort(code, kind="stable")
        y, code = y[order], code[order]
        sums = np.zeros((len(x), len(labels)))
        for low in range(0, len(y), block):
            part, kind = y[low : low + block], code[low : low + block]
            starts = np.flatnonzero(np.diff(kind, prepend=-1))
            for top in range(0, len(x), tile):
                some = x[top : top + tile]
                d2 = np.zeros((len(some), len(part)))
                for j in range(x.shape[1]):
                    d = some[:, j : j + 1] - part[None, :, j]
                    d2 += np.multiply(d, d, out=d)
                dist = np.sqrt(d2, out=d2)
                if len(starts) == 1:
                    sums[top : top + tile, kind[0]] += dist.sum(axis=1)
                else:
                    sums[top : top + tile, kind[starts]] += np.add.reduceat(dist, starts, axis=1)
        return pd.DataFrame({
            key: np.repeat(mine[key].to_numpy(), len(labels)), "other": np.tile(labels, len(x)), "total": sums.ravel()})

    kinds = dict(rows.dtypes)
    met = left.cogroup(right).applyInPandas(meet, f"{key} {kinds[key]}, other {kinds['_label']}, total double")
    return met.groupBy(key, "other").agg(F.sum("total").alias("total"))


def _means(sums: DataFrame, sizes: DataFrame, rows: DataFrame, label: str, key: str) -> DataFrame:
    """(key, label, a, b): mean distance to the own cluster and smallest to another, of (key, other, total)."""
    per = sums.join(sizes, "other").join(rows.select(key, label), key)
    inner, mean = F.col("other") == F.col(label), F.col("total") / F.col("size")
    return per.groupBy(key, label).agg(
        F.max(F.when(inner, F.try_divide(F.col("total"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~inner, mean)).alias("b"))


def _plane_means(rows: DataFrame, cols: Sequence[str], label: str, key: str) -> DataFrame:
    """``_means`` of two finite or missing coordinates by trees of cells, without comparing all pairs.

    Where keys repeat or coordinates are missing, the sums to all clusters are kept and treated as there.
    """
    names = ["x0", "x1"]
    # adding zero removes a negative zero, as grouping does
    held = rows.select(
        F.col(key).alias("_key"), F.col(label).alias("_label"),
        *[(F.nanvl(F.col(c).cast("double"), F.lit(None)) + F.lit(0.0)).alias(x) for c, x in zip(cols, names)])
    lost = F.col("x0").isNull() | F.col("x1").isNull()
    of_whole = lambda x: F.when(~lost, F.col(x))
    clusters = held.groupBy("_label").agg(
        F.count(F.lit(1)).alias("size"), F.count_if(lost).alias("lost"), *[F.avg(of_whole(x)) for x in names],
        *[F.var_pop(of_whole(x)) for x in names]).orderBy("_label").collect()  # one row per cluster
    spark, kind = rows.sparkSession, dict(rows.dtypes)[label]
    codes = F.broadcast(spark.createDataFrame(
        [(i, c["_label"], c["size"], c["lost"] > 0) for i, c in enumerate(clusters)],
        f"code int, _label {kind}, size long, holed boolean"))
    numbers = np.array([[np.nan if v is None else v for v in c[3:]] for c in clusters], float)
    coded = held.join(codes, "_label")
    points = cut_lineage(coded.where(~lost).groupBy("code", *names).agg(F.count(F.lit(1)).alias("w")))
    every = any(c["lost"] for c in clusters) or not (
        held.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty())
    found = cluster_distances(
        points, np.array([c["size"] for c in clusters], float), numbers[:, :2], numbers[:, 2:].sum(axis=1), every)
    release(points)
    if not every:
        return coded.where(F.col("_key").isNotNull()).join(found, ["code", *names]).select(
            F.col("_key").alias(key), F.col("_label").alias(label),
            F.try_divide(F.col("inner"), F.col("size") - 1).alias("a"), F.nanvl("outer", F.lit(None)).alias("b"))
    others = codes.select(F.col("code").alias("other"), F.col("_label").alias("_other"), F.col("holed").alias("_holed"))
    sums = coded.join(found, ["code", *names]).join(others, "other").where("not _holed").select("_key", "_other", "total")
    # no sum over a missing coordinate has a value
    blank = coded.withColumn("_lost", lost).crossJoin(others).where("_lost or _holed").select(
        "_key", "_other", F.lit(None).cast("double").alias("total"))
    sums = sums.unionByName(blank).groupBy(F.col("_key").alias(key), F.col("_other").alias("other")).agg(
        F.sum("total").alias("total"))
    return _means(sums, codes.select(F.col("_label").alias("other"), "size"), rows, label, key)


def silhouette_samples(
    df: DataFrame, cols: Sequence[str], label: str, sample: int | None, seed: int = 42, key: str = "row_id"
) -> DataFrame:
    """Euclidean silhouette of each row of a seeded sample, within that sample; None takes all rows.

    The measure needs the distances among all rows it looks at. On two columns trees of cells sum them up in
    time that grows with the rows; on more, or few rows, every pair is compared, and ``silhouette_fast``
    is the linear alternative.
    """
    narrow = df.select(key, label, *cols)
    rows = cut_lineage(narrow if sample is None else sample_exact(narrow, sample, seed, key))
    n, unnamed, endless = rows.agg(
        F.count(F.lit(1)), F.count_if(F.col(label).isNull()),
        F.count_if(F.greatest(F.lit(0.0), *[F.nanvl(F.abs(F.col(c).cast("double")), F.lit(0.0)) for c in cols]) == float("inf")),
    ).first()
    sizes = rows.groupBy(F.col(label).alias("other")).agg(F.count(F.lit(1)).alias("size"))
    if len(cols) == 2 and not unnamed and not endless and (n > DIRECT_ROWS or n * sizes.count() > DIRECT_SUMS):
        both = _plane_means(rows, cols, label, key)
    else:
        groups = max(1, min(SILHOUETTE_GROUPS, -(-n // SILHOUETTE_BLOCK)), -(-n // GROUP_ROWS))
        sums = _distance_sums(rows.withColumn("_label", F.col(label)), list(cols), key, groups)
        both = _means(sums, sizes, rows, label, key)
    s = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return both.select(key, label, F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(s, F.lit(0.0))).alias("silhouette"))


def silhouette_exact(df: DataFrame, cols: Sequence[str], label: str, sample: int | None, seed: int = 42, key: str = "row_id") -> DataFrame:
    """One row: mean Euclidean silhouette of the sample, or of all rows."""
    return silhouette_samples(df, cols, label, sample, seed, key).agg(
        F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette")
    )


def silhouette_fast(df: DataFrame, cols: Sequence[str], label: str) -> float:
    """Squared-Euclidean silhouette of all rows; linear in the rows, but another number."""
    data = _vectors(df, cols, label)
    return ClusteringEvaluator(predictionCol=label, distanceMeasure="squaredEuclidean").evaluate(data)


def k_scan(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int], seeds: Sequence[int],
    sample: int = 40_000, silhouette_rows: int | None = 8_000, n_init: int = 1, key: str = "row_id",
) -> tuple[DataFrame, DataFrame]:
    """Inertia and silhouette of each k on several samples: the summary and the wins per k.

    On each sample, all k and all ``n_init`` starts are fitted in the same passes.
    """
    runs = []
    for seed in seeds:
        part = cut_lineage(sample_exact(df.select(key, *cols), sample, seed, key))
        plan = [(k, seed * 1000 + i) for k in ks for i in range(n_init)]
        fits = kmeans_runs(part, cols, plan, key)
        for k in ks:
            fit = min((f for (kk, _), f in zip(plan, fits) if kk == k), key=lambda f: f.cost)
            s = silhouette_exact(assign_nearest(part, fit), cols, "cluster", silhouette_rows, seed, key)
            runs.append((seed, k, fit.cost, s.first()["silhouette"]))
    table = df.sparkSession.createDataFrame(runs, "seed int, k int, inertia double, silhouette double")
    summary = table.groupBy("k").agg(
        F.avg("inertia").alias("inertia"), F.avg("silhouette").alias("silhouette"),
        F.stddev_pop("silhouette").alias("silhouette_std"),
    ).orderBy("k")
    return summary, winner_by(table, "seed", "silhouette", "k")


def name_clusters(profile: DataFrame, cluster: str, rate: str, out: str = "segment") -> DataFrame:
    """Lowest outcome rate is Prime, highest Higher-risk, all between Mid-risk."""
    low = Window.orderBy(F.col(rate), F.col(cluster))  # one row per cluster
    high = Window.orderBy(F.desc(rate), F.desc(cluster))
    named = (
        F.when(F.row_number().over(low) == 1, "Prime")
        .when(F.row_number().over(high) == 1, "Higher-risk").otherwise("Mid-risk")
    )
    return profile.withColumn(out, named)


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: Adjusted Rand Index of two labelings, from their contingency table."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("n"))
    sums = None
    for name, t in (("cells", cells), ("rows", rows), ("cols", cols)):
        part = t.select(F.lit(name).alias("part"), pairs_of(F.col("n")).alias("p"), "n")
        sums = part if sums is None else sums.unionByName(part)
    pick = lambda p: F.sum(F.when(F.col("part") == p, F.col("p")))
    totals = sums.agg(
        pick("cells").alias("s"), pick("rows").alias("ra"), pick("cols").alias("rb"),
        pairs_of(F.sum(F.when(F.col("part") == "cells", F.col("n")))).alias("t"),
    )
    expected = F.try_divide(F.col("ra") * F.col("rb"), F.col("t"))
    best = (F.col("ra") + F.col("rb")) / 2
    # without any pair of rows both labelings agree
    alike = F.coalesce(best == expected, F.lit(True))
    return totals.select(
        F.when(alike, F.lit(1.0)).otherwise(F.try_divide(F.col("s") - expected, best - expected)).alias("ari")
    )


def compare_algorithms(rows: Sequence[DataFrame]) -> DataFrame:
    """Union of one-row results (algorithm, parameters, role, metric)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out
