"""Principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.columns import linear_sql, quoted
from orebed.operators.correlation import covariance


@dataclass(frozen=True)
class Components:
    cols: tuple[str, ...]
    means: np.ndarray
    loadings: np.ndarray  # p x p, one column per component
    ratios: np.ndarray

    def count_for(self, variance: float) -> int:
        """Smallest number of components that explains at least ``variance``."""
        reached = np.nonzero(np.cumsum(self.ratios) >= variance - 1e-12)[0]
        return int(reached[0]) + 1 if len(reached) else len(self.cols)


def pca_fit(df: DataFrame, cols: Sequence[str]) -> Components:
    """Components from one covariance pass; only the p x p matrix reaches the driver.

    Each component's largest loading is made positive.
    """
    means, cov, _ = covariance(df, cols)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0, None), vectors[:, order]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[top, range(len(cols))] < 0, -1.0, 1.0)
    return Components(tuple(cols), means, vectors, values / values.sum())


def pca_scores(df: DataFrame, fit: Components, k: int, key: str = "row_id", names: Sequence[str] | None = None) -> DataFrame:
    """Row key and the first ``k`` centred component scores."""
    names = names or [f"PC{i + 1}" for i in range(k)]
    terms = [quoted(c) for c in fit.cols]
    scores = [
        F.expr(linear_sql(terms, fit.loadings[:, i], fit.means)).alias(names[i]) for i in range(k)
    ]
    return df.select(key, *scores)


def pca_reduce(df: DataFrame, cols: Sequence[str], variance: float = 0.90, key: str = "row_id") -> tuple[DataFrame, Components]:
    """Scores of as few components as explain the wanted variance."""
    fit = pca_fit(df, cols)
    return pca_scores(df, fit, fit.count_for(variance), key), fit


def project_2d(df: DataFrame, cols: Sequence[str], key: str = "row_id", fit: Components | None = None) -> DataFrame:
    """First two component scores of all rows, the input of density clustering; ``fit`` where it is known."""
    return pca_scores(df, fit or pca_fit(df, cols), 2, key, ["x", "y"])


def variance_ratios(df: DataFrame, fit: Components) -> DataFrame:
    rows = [(i + 1, float(r)) for i, r in enumerate(fit.ratios)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double")


def pca_loadings(df: DataFrame, fit: Components, k: int, top: int | None = None) -> DataFrame:
    """Loading of each feature on each component, optionally the strongest few."""
    rows = [
        (i + 1, c, float(fit.loadings[j, i])) for i in range(k) for j, c in enumerate(fit.cols)
    ]
    table = df.sparkSession.createDataFrame(rows, "component int, feature string, loading double")
    w = Window.partitionBy("component").orderBy(F.desc(F.abs("loading")), "feature")
    ranked = table.withColumn("rank", F.row_number().over(w))
    return ranked if top is None else ranked.where(F.col("rank") <= top)
