"""Pairwise-complete Pearson correlation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.functions.columns import quoted
from orebed.functions.orderstats import aggregate_row
from orebed.session import cut_lineage, release

EXPRESSION_PAIRS = 200  # pairs up to which those whose sums cancel are computed again as plain aggregates
CANCELLED = 1e-6  # variance, as a share of the sum of squares, below which centred sums are not trusted
ROUNDING = 1e-12  # variance, as a share of the sum of squares, that rounding alone can leave
GRAM_SCHEMA = (
    "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
)


def _gram_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sums over pairwise-complete rows for every column pair, in one pass.

    Each task folds its Arrow batches into p x p matrix products and emits
    p(p+1)/2 rows, whatever the number of input rows. Values are centred by the
    column means first, so that squares do not cancel.
    """
    df = df.select(*[F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    means = aggregate_row(df, [F.avg(F.nanvl(F.col(c), F.lit(None))) for c in df.columns])
    shift = np.array([m if m is not None else 0.0 for m in means])
    p = len(cols)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, p, p))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - shift
            m = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        n, s, q, xy = total
        i, j = np.triu_indices(p)
        yield pd.DataFrame({
            "i": i, "j": j, "n": n[i, j], "sx": s[i, j], "sy": s[j, i],
            "sxx": q[i, j], "syy": q[j, i], "sxy": xy[i, j],
        })

    parts = df.mapInPandas(fold, GRAM_SCHEMA)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def _pair_sql(a: str, b: str) -> str:
    """Struct of n, variances and covariance over the complete rows of a pair, and the ends of both sides."""
    x, y = (f"nullif(CAST({quoted(c)} AS DOUBLE), DOUBLE('NaN'))" for c in (a, b))
    x, y = f"IF({y} IS NULL, NULL, {x})", f"IF({x} IS NULL, NULL, {y})"
    return (
        f"struct(min({x}) AS x0, max({x}) AS x1, min({y}) AS y0, max({y}) AS y1, "
        f"var_pop({x}) AS vx, var_pop({y}) AS vy, covar_pop({x}, {y}) AS c)"
    )


def pair_correlations(df: DataFrame, cols: Sequence[str]) -> list[tuple[str, str, float | None]]:
    """(a, b, r) for the strict upper triangle; rows with a null or NaN in the pair are skipped.

    r is null where either side does not vary among the complete rows. The
    p (p - 1) / 2 numbers come to the driver: meant for some thousand columns.
    The columns are written once, narrow, so that ``df`` is computed once. Up to
    ``EXPRESSION_PAIRS`` pairs, those whose centred sums cancel are settled by
    plain aggregates, which tell a constant side exactly.
    """
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return []
    names = [f"x{i}" for i in range(len(cols))]
    narrow = cut_lineage(df.select(*[F.col(quoted(c)).cast("double").alias(x) for c, x in zip(cols, names)]))
    exact = len(pairs) <= EXPRESSION_PAIRS
    least = CANCELLED if exact else ROUNDING
    found, sure = {}, set()
    for r in _gram_sums(narrow, names).where("i < j").collect():
        if r["n"] > 1:
            cov = r["sxy"] - r["sx"] * r["sy"] / r["n"]
            vx = r["sxx"] - r["sx"] ** 2 / r["n"]
            vy = r["syy"] - r["sy"] ** 2 / r["n"]
            if vx > least * r["sxx"] and vy > least * r["syy"]:
                found[r["i"], r["j"]] = float(cov / np.sqrt(vx * vy))
        else:
            sure.add((r["i"], r["j"]))  # no two complete rows: nothing varies
    open_ = [p for p in pairs if p not in found and p not in sure] if exact else []
    for p, v in zip(open_, aggregate_row(narrow, [F.expr(_pair_sql(names[i], names[j])) for i, j in open_], 40)):
        varies = v["x0"] is not None and v["x0"] < v["x1"] and v["y0"] < v["y1"] and v["vx"] * v["vy"] > 0
        if varies:
            found[p] = v["c"] / math.sqrt(v["vx"] * v["vy"])
    release(narrow)
    return [(cols[i], cols[j], found.get((i, j))) for i, j in pairs]


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full matrix in long form (a, b, r)."""
    upper = pair_correlations(df, cols)
    rows = [(c, c, 1.0) for c in cols] + upper + [(b, a, r) for a, b, r in upper]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def high_corr_pairs(df: DataFrame, cols: Sequence[str], thr: float = 0.8) -> DataFrame:
    """Column pairs with |r| above the threshold, strongest first."""
    rows = [x for x in pair_correlations(df, cols) if x[2] is not None and abs(x[2]) > thr]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double").orderBy(
        F.desc(F.abs("r")), "a", "b"
    )


def max_abs_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: largest off-diagonal |r|."""
    rows = pair_correlations(df, cols)
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double").agg(
        F.max(F.abs("r")).alias("max_abs_r")
    )


def covariance(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Means, sample covariance matrix and row count of null-free rows."""
    cols = list(cols)
    clean = df.select(*cols).na.drop("any")
    p = len(cols)
    if p * (p + 1) // 2 <= EXPRESSION_PAIRS:
        pairs = [(i, j) for i in range(p) for j in range(i, p)]
        vals = aggregate_row(
            clean, [F.count(F.lit(1))] + [F.avg(c) for c in cols]
            + [F.expr(f"covar_samp({quoted(cols[i])}, {quoted(cols[j])})") for i, j in pairs]
        )
        n, means, covs = vals[0], np.array(vals[1 : p + 1], dtype=float), vals[p + 1 :]
        out = np.zeros((p, p))
        for (i, j), v in zip(pairs, covs):
            out[i, j] = out[j, i] = v
        return means, out, n
    means = np.array(aggregate_row(clean, [F.avg(c) for c in cols]), dtype=float)
    out, n = np.zeros((p, p)), 0
    for r in _gram_sums(clean, cols).collect():
        n = int(r["n"])
        v = (r["sxy"] - r["sx"] * r["sy"] / n) / (n - 1)
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = v
    return means, out, n
