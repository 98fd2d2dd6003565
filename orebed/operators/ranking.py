"""Cut-offs on sorted scores and sorted curves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.orderstats import exact_quantile, order_statistics, ranked_values


@dataclass(frozen=True)
class Gap:
    rank: int
    threshold: float
    size: float


def largest_gap(df: DataFrame, score: str, lo: float, hi: float) -> Gap:
    """Largest drop between neighbours of the descending score curve.

    Only drops below ranks ``n*lo`` to ``n*hi`` count; the first of equal drops
    wins. Rows at or above the returned threshold lie above the drop.
    """
    return _largest_gaps(df, score, [(lo, hi)])[0][0]


def _largest_gaps(df: DataFrame, score: str, windows: list[tuple[float, float]]) -> tuple[list[Gap], int]:
    """The gap of each window and the number of scores: one curve, as deep as the widest window, and one pass over it."""
    n = df.where(F.col(score).isNotNull()).count()
    bounds = [(int(n * lo), int(n * hi)) for lo, hi in windows]
    if any(last - first < 2 for first, last in bounds):
        raise ValueError("the searched tail holds fewer than two scores")
    deepest = n - max(last for _, last in bounds)
    floor = order_statistics(df, {score: [deepest]})[score, deepest]
    curve = ranked_values(df.where(F.col(score) >= floor), score, descending=True)
    # drops between equal scores are 0: only the last row of each value matters
    drop = F.struct((F.col("next_value") - F.col("value")).alias("drop"), "upto", "value")
    inside = lambda first, last: (F.col("upto") > first) & (F.col("upto") < last) & F.col("next_value").isNotNull()
    found = curve.agg(*[F.min(F.when(inside(*w), drop)).alias(f"g{i}") for i, w in enumerate(bounds)]).first()
    gaps = []
    for i, (first, _) in enumerate(bounds):
        best = found[f"g{i}"]
        if best is None:
            at = order_statistics(df, {score: [n - first - 1]})[score, n - first - 1]
            gaps.append(Gap(first + 1, at, 0.0))
        else:
            gaps.append(Gap(best["upto"], best["value"], -best["drop"]))
    return gaps, n


def gap_stability(df: DataFrame, score: str, windows: list[tuple[float, float]]) -> DataFrame:
    """Cut rank, its share of rows and drop size for several search windows."""
    gaps, n = _largest_gaps(df, score, windows)
    rows = [(lo, hi, g.rank, 100.0 * g.rank / n, g.size) for (lo, hi), g in zip(windows, gaps)]
    return df.sparkSession.createDataFrame(
        rows, "lo double, hi double, cut_rank bigint, pct_rows double, gap double"
    )


@dataclass(frozen=True)
class Knee:
    rank: int
    value: float


def knee_chord(df: DataFrame, value: str, weight: str | None = None) -> Knee:
    """Point of the ascending curve farthest below the chord between its ends.

    Among equal values the chord is highest at the last position, so one
    candidate per distinct value is enough. ``rank`` counts from 0.
    """
    curve = ranked_values(df, value, weight)
    ends = curve.agg(F.sum("n").alias("n"), F.min("value").alias("a"), F.max("value").alias("b")).first()
    if ends["n"] < 2 or ends["a"] == ends["b"]:
        return Knee(0, ends["a"])
    slope = (ends["b"] - ends["a"]) / (ends["n"] - 1)
    pos = F.col("upto") - 1
    below = F.lit(ends["a"]) + F.lit(slope) * pos - F.col("value")
    best = curve.agg(F.min(F.struct((-below).alias("d"), pos.alias("pos"), "value")).alias("b")).first()["b"]
    return Knee(best["pos"], best["value"])


def components_for(ratios: DataFrame, threshold: float, order: str = "component", ratio: str = "ratio") -> DataFrame:
    """Running sum of variance ratios and the first component reaching the threshold."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)  # one row per component
    running = ratios.withColumn("cumulative", F.sum(ratio).over(w))
    first = F.min(F.when(F.col("cumulative") >= threshold, F.col(order))).over(Window.partitionBy())
    return running.withColumn("n_components", first)


def winner_by(df: DataFrame, by: str, metric: str, candidate: str) -> DataFrame:
    """How often each candidate has the best metric within a group; ties go to the smallest."""
    best = df.groupBy(by).agg(F.min(F.struct((-F.col(metric)).alias("m"), F.col(candidate).alias("c"))).alias("b"))
    return best.groupBy(F.col("b.c").alias(candidate)).agg(F.count(F.lit(1)).alias("wins"))


def percentile_threshold(df: DataFrame, score: str, prob: float, subset=None) -> float | None:
    """Exact percentile of a score among a subset of rows."""
    return exact_quantile(df if subset is None else df.where(subset), score, prob)


def top_cut(df: DataFrame, score: str, share: float) -> float | None:
    """Score at rank ``n*share`` from the top among the n rows that have one."""
    n = df.where(F.col(score).isNotNull()).count()
    if not n:
        return None
    at = n - max(int(n * share), 1)
    return order_statistics(df, {score: [at]})[score, at]


def top_fraction(df: DataFrame, score: str, share: float, out: str = "in_top") -> DataFrame:
    """Flag the rows at or above the score of rank ``n*share`` (ties included)."""
    return df.withColumn(out, F.coalesce(F.col(score) >= F.lit(top_cut(df, score, share)), F.lit(False)))
