"""Exact-size seeded samples that depend on the row key only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.columns import clip, sampling_hash
from orebed.functions.orderstats import order_statistics

TOP_ROWS = 100_000     # largest sample taken as one top-n merge
TOP_SLICES = 64  # parts of a group that are ranked before they meet
NAMED_GROUPS = 100_000  # groups whose cuts are sent to every task
PLAIN_ROWS = 1_000_000  # tables whose tasks may each offer n rows to that merge


def sample_exact(df: DataFrame, n: int, seed: int, key: str | Sequence[str] = "row_id") -> DataFrame:
    """``n`` rows without replacement: those with the smallest seeded key hash.

    On a large table only rows below a hash cut are sorted. For a small sample
    the cut is set a little too high and checked by counting; for a large one
    it is the exact hash at rank ``n``, and the sample is a filter.
    """
    keys = [F.col(k) for k in ([key] if isinstance(key, str) else key)]
    hashed = df.withColumn("_h", sampling_hash(keys, seed))
    total = df.count()
    if total <= n:
        return df
    if total <= PLAIN_ROWS and n <= TOP_ROWS:
        return hashed.orderBy("_h", *keys).limit(n).drop("_h")
    # 13 hex digits fit a double exactly; the text order equals the number order
    numbered = hashed.withColumn("_v", F.conv(F.substring("_h", 1, 13), 16, 10).cast("double"))
    if n <= TOP_ROWS:
        share = (n + 8 * math.sqrt(n) + 50) / total
        likely = numbered.where(F.col("_v") < share * 2.0**52)
        if likely.count() >= n:
            return likely.orderBy("_h", *keys).limit(n).drop("_h", "_v")
    cut = order_statistics(numbered, {"_v": [n - 1]})["_v", n - 1]
    below = numbered.where(F.col("_v") < cut)
    missing = n - below.count()
    ties = numbered.where(F.col("_v") == cut).orderBy("_h", *keys).limit(missing)
    return below.unionByName(ties).drop("_h", "_v")


def _below_cuts(df: DataFrame, by: Sequence[str], n: int, value: str) -> DataFrame:
    """Rows of ``df`` that can be among the ``n`` smallest ``value`` (uniform in [0, 1)) of their group.

    Group sizes give each group a cut that leaves a little more than ``n`` rows;
    groups that fall short get a wider one, until none does. The cuts of up to
    ``NAMED_GROUPS`` groups are broadcast, so that no group is gathered to meet its cut.
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    groups = sizes.count()
    slack = 8 * math.sqrt(n) + 50
    while True:
        named = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], ((n + slack) / F.col("_n")).alias("_cut"), "_n")
        match = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)]
        cut = df.join(F.broadcast(named) if groups <= NAMED_GROUPS else named, match).where(F.col(value) < F.col("_cut"))
        left = cut.groupBy(*[f"_g{i}" for i in range(len(by))]).agg(F.count(F.lit(1)).alias("_left"), F.first("_n").alias("_n"))
        met = left.agg(F.count(F.lit(1)), F.count_if(F.col("_left") < F.least(F.lit(n), F.col("_n")))).first()
        if not met[1] and met[0] == groups:
            return cut.drop("_cut", "_n", *[f"_g{i}" for i in range(len(by))])
        slack *= 4


def stratified_sample(df: DataFrame, by: str, n: int, seed: int, key: str = "row_id") -> DataFrame:
    """``min(n, group size)`` rows of each group: those with the smallest seeded key hash.

    Only rows below a hash cut of their group are ranked, about ``n`` of each,
    so a large group is never gathered.
    """
    hashed = df.withColumn("_h", sampling_hash(F.col(key), seed))
    hashed = hashed.withColumn("_v", F.conv(F.substring("_h", 1, 13), 16, 10).cast("double") / 2.0**52)
    w = Window.partitionBy(by).orderBy("_h", key)
    few = _below_cuts(hashed, [by], n, "_v")
    return few.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn", "_h", "_v")


def union_samples(parts: Sequence[DataFrame]) -> DataFrame:
    """Row-wise union by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scatter_extract(
    df: DataFrame, x: str, y: str, label: str, n: int, seed: int = 42,
    by: str | None = None, clip_x: float | None = None, key: str = "row_id",
) -> DataFrame:
    """Sampled rows of two columns with a group label, overall or per group."""
    cols = list(dict.fromkeys([key, x, y, label] + ([by] if by else [])))
    narrow = df.select(*cols)
    rows = stratified_sample(narrow, by, n, seed, key) if by else sample_exact(narrow, n, seed, key)
    return rows.select(
        key, clip(F.col(x), None, clip_x).alias(x), y, label
    )


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows of an order that ends in a unique key."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group, with their rank.

    Rows are first ranked within hashed slices of their group, each slice sends
    on its first ``k``, and only these are ranked together.
    """
    keys = [by] if isinstance(by, str) else list(by)
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(TOP_SLICES)))
    inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
    first = sliced.withColumn("_rn", F.row_number().over(inner)).where(F.col("_rn") <= k).drop("_rn", "_slice")
    return first.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)
