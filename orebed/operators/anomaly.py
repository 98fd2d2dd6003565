"""Outlier flags by several methods, their consensus and classification."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.columns import number, quoted, zscore
from orebed.functions.orderstats import exact_quantile, exact_quantiles
from orebed.functions.stats import chi2_quantile
from orebed.operators.columns import moments
from orebed.operators.correlation import covariance
from orebed.operators.ranking import largest_gap, percentile_threshold, top_cut
from orebed.session import cut_lineage, release


def _false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def iqr_tests(df: DataFrame, cols: Sequence[str], mult: float = 3.0) -> dict[str, Column]:
    """Predicate per column: outside the fences at ``mult`` interquartile ranges."""
    out = {}
    for c, (q1, q3) in exact_quantiles(df, cols, [0.25, 0.75]).items():
        if q1 is None:
            out[c] = F.lit(False)
        else:
            reach = mult * (q3 - q1)
            out[c] = _false((F.col(c) < q1 - reach) | (F.col(c) > q3 + reach))
    return out


def zscore_tests(df: DataFrame, cols: Sequence[str], thr: float = 3.0) -> dict[str, Column]:
    """Predicate per column: more than ``thr`` population deviations from the mean."""
    out = {}
    for c, (mean, std) in moments(df, cols).items():
        out[c] = _false(F.abs(zscore(F.col(c), mean, std)) > thr) if std else F.lit(False)
    return out


def _any(tests: dict[str, Column]) -> Column:
    out = F.lit(False)
    for t in tests.values():
        out = out | t
    return out


def iqr_flags(df: DataFrame, cols: Sequence[str], mult: float = 3.0, out: str = "flag_iqr") -> DataFrame:
    return df.withColumn(out, _any(iqr_tests(df, cols, mult)))


def zscore_flags(df: DataFrame, cols: Sequence[str], thr: float = 3.0, out: str = "flag_z") -> DataFrame:
    return df.withColumn(out, _any(zscore_tests(df, cols, thr)))


def flag_counts(df: DataFrame, cols: Sequence[str], mult: float = 3.0, thr: float = 3.0) -> DataFrame:
    """Rows flagged by each univariate method per feature, and in total."""
    iqr, z = iqr_tests(df, cols, mult), zscore_tests(df, cols, thr)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(iqr[c]).alias(f"i{i}"), F.count_if(z[c]).alias(f"z{i}")]
    row = df.agg(*aggs, F.count_if(_any(iqr)).alias("it"), F.count_if(_any(z)).alias("zt")).first()
    rows = [(c, row[f"i{i}"], row[f"z{i}"]) for i, c in enumerate(cols)] + [("ANY", row["it"], row["zt"])]
    return df.sparkSession.createDataFrame(rows, "feature string, n_iqr bigint, n_z bigint")


def mahalanobis(
    df: DataFrame, cols: Sequence[str], q: float = 0.999, out: str = "maha_dist2", flag: str = "flag_maha"
) -> DataFrame:
    """Squared Mahalanobis distance and a flag beyond the chi-square quantile.

    Only means and the p x p covariance are fitted; the quadratic form is one
    expression. Columns are standardized through the covariance itself.
    """
    means, cov, _ = covariance(df, cols)
    scale = np.sqrt(np.where(np.diag(cov) > 0, np.diag(cov), 1.0))
    inverse = np.linalg.pinv(cov / np.outer(scale, scale), hermitian=True)
    z = [f"(({quoted(c)} - {number(m)}) / {number(s)})" for c, m, s in zip(cols, means, scale)]
    # symmetric form: each off-diagonal term once, with twice its weight
    weights = np.triu(2 * inverse, 1) + np.diag(np.diag(inverse))
    form = " + ".join(
        f"{z[i]} * (" + " + ".join(f"{z[j]} * {number(weights[i, j])}" for j in range(i, len(cols))) + ")"
        for i in range(len(cols))
    )
    total = F.expr(form)
    return df.withColumn(out, total).withColumn(flag, _false(F.col(out) > chi2_quantile(q, len(cols))))


# -- isolation forest ---------------------------------------------------------

def _path_constant(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        harmonic = np.log(n - 1) + 0.5772156649015329 + 1 / (2 * (n - 1)) - 1 / (12 * (n - 1) ** 2)
        c = 2 * harmonic - 2 * (n - 1) / n
    return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> pd.DataFrame:
    """Node table of one isolation tree: node i splits into nodes left and left + 1."""
    nodes, stack = [[-1, 0.0, -1, 0.0]], [(0, np.arange(len(x)), 0)]
    while stack:
        at, rows, depth = stack.pop()
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.nonzero(hi > lo)[0]
        if depth >= limit or len(rows) < 2 or not len(usable):
            nodes[at][3] = depth + float(_path_constant(len(rows)))
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(lo[f], hi[f]))
        goes_left = x[rows, f] <= cut
        left = len(nodes)
        nodes += [[-1, 0.0, -1, 0.0], [-1, 0.0, -1, 0.0]]
        nodes[at][:3] = [f, cut, left]
        stack += [(left, rows[goes_left], depth + 1), (left + 1, rows[~goes_left], depth + 1)]
    return pd.DataFrame(nodes, columns=["feature", "cut", "left", "path"])


def _walkable(tree: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Arrays of one tree in which a leaf leads to itself, and the number of levels to walk."""
    feature, cut, left, path = (tree[c].to_numpy() for c in ("feature", "cut", "left", "path"))
    leaf = feature < 0
    level = np.zeros(len(tree), dtype=int)
    for at in np.flatnonzero(~leaf):  # children stand behind their parent
        level[left[at] : left[at] + 2] = level[at] + 1
    own = np.where(leaf, np.arange(len(tree)), left)
    return np.where(leaf, 0, feature), np.where(leaf, np.inf, cut), own, path, int(level.max(initial=0))


def isolation_trees(
    df: DataFrame, cols: Sequence[str], trees: int = 100, psi: int = 256, seed: int = 42, key: str = "row_id"
) -> DataFrame:
    """Node rows of the forest, one group of at most ``psi`` rows per tree.

    Every tree draws from all rows: those with its smallest seeded hashes. A cut
    on the hashes leaves about four times ``psi`` rows per tree to be ranked; it
    is raised for as long as a tree falls short of rows that the table has.
    """
    names = list(cols)
    rows = df.select(key, *names).na.drop("any")
    size = rows.count()
    wanted = min(psi, size)
    factor = 4.0
    while True:
        share = min(1.0, factor * psi / max(size, 1))
        cut = F.lit(int(share * 2**53))
        each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        drawn = each.withColumn("_h", F.pmod(F.xxhash64(F.col(key), F.col("tree"), F.lit(seed)), F.lit(2**53))).where(F.col("_h") < cut)
        likely = cut_lineage(drawn)  # about ``factor * psi`` rows a tree, counted and then ranked
        if share >= 1.0 or likely.groupBy("tree").count().where(F.col("count") >= wanted).count() == trees:
            break
        release(likely)
        factor *= 4
    per_tree = Window.partitionBy("tree").orderBy("_h", key)
    drawn = likely.withColumn("_rn", F.row_number().over(per_tree)).where(F.col("_rn") <= psi)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        x = rows.sort_values("_rn")[names].to_numpy(dtype=float)
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes = _grow(x, np.random.default_rng([seed, tree]), limit)
        nodes.insert(0, "node", range(len(nodes)))
        nodes.insert(0, "tree", tree)
        nodes["rows"] = len(x)
        return nodes

    return drawn.select("tree", "_rn", *names).groupBy("tree").applyInPandas(
        build, "tree int, node int, feature int, cut double, left int, path double, rows int"
    )


def isolation_forest(
    df: DataFrame, cols: Sequence[str], trees: int = 100, psi: int = 256, contamination: float = 0.01,
    seed: int = 42, key: str = "row_id", out: str = "if_score", flag: str = "flag_if",
) -> DataFrame:
    """(key, score, flag): isolation score in (0, 1) and the rows above its exact quantile.

    Trees are built in parallel from bounded samples. The node tables, at most
    ``trees * (2 psi - 1)`` rows, are broadcast, and all rows are scored in
    Arrow batches.
    """
    scores = isolation_scores(df, cols, trees, psi, seed, key, out)
    scores = cut_lineage(scores)  # scored once, read again for the cut-off
    cut = exact_quantile(scores, out, 1 - contamination)
    return scores.withColumn(flag, F.coalesce(F.col(out) > F.lit(cut), F.lit(False)))


def isolation_scores(
    df: DataFrame, cols: Sequence[str], trees: int = 100, psi: int = 256, seed: int = 42,
    key: str = "row_id", out: str = "if_score",
) -> DataFrame:
    """(key, score) of every row; the score is null where a feature is."""
    names = list(cols)
    nodes = isolation_trees(df, names, trees, psi, seed, key).toPandas().sort_values(["tree", "node"])
    forest = [_walkable(t) for _, t in nodes.groupby("tree")]
    norm = float(_path_constant(nodes["rows"].max())) if len(nodes) else 0.0
    shared = df.sparkSession.sparkContext.broadcast((forest, norm))
    rows = df.select(key, *names)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown, c = shared.value
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            known = ~np.isnan(x).any(axis=1)
            depth = np.zeros(len(x))
            flat, base = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * len(names)
            for feature, cut, left, path, levels in grown:
                at = np.zeros(len(x), dtype=int)
                for _ in range(levels):
                    at = left[at] + (flat[base + feature[at]] > cut[at])
                depth += path[at]
            found = np.where(known, 2.0 ** (-depth / (len(grown) * c)), np.nan) if c > 0 else np.where(known, 0.5, np.nan)
            yield pd.DataFrame({key: batch[key], out: pd.Series(found, index=batch.index).astype("Float64")})

    return rows.mapInPandas(score, f"{key} {df.schema[key].dataType.simpleString()}, {out} double")


# -- consensus and classes ----------------------------------------------------


def consensus(df: DataFrame, flags: Sequence[str], out: str = "n_methods") -> DataFrame:
    """Number of methods that flag each row, candidate (1 or more) and confirmed (2 or more)."""
    n = F.lit(0)
    for f in flags:
        n = n + _false(F.col(f)).cast("int")
    return df.withColumn(out, n).withColumns({"candidate": F.col(out) >= 1, "confirmed": F.col(out) >= 2})


def consensus_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row: flagged rows per method and rows with at least 1, 2 and 3 methods."""
    n = F.col("n_methods")
    return df.agg(
        *[F.count_if(F.col(f)).alias(f) for f in flags],
        *[F.count_if(n >= k).alias(f"at_least_{k}") for k in (1, 2, 3)],
    )


def consensus_sensitivity(df: DataFrame, base: Sequence[str], masks: dict[str, Column], at_least: int = 2) -> DataFrame:
    """Confirmed rows when one method's cut-off is replaced by each alternative."""
    n = F.lit(0)
    for f in base:
        n = n + _false(F.col(f)).cast("int")
    aggs = []
    for i, m in enumerate(masks.values()):
        aggs += [F.count_if(m).alias(f"f{i}"), F.count_if(n + _false(m).cast("int") >= at_least).alias(f"c{i}")]
    row = df.agg(*aggs).first()
    rows = [(name, row[f"f{i}"], row[f"c{i}"]) for i, name in enumerate(masks)]
    return df.sparkSession.createDataFrame(rows, "cutoff string, flagged bigint, confirmed bigint")


def score_cutoffs(df: DataFrame, score: str, flag: str, gap: tuple[float, float] = (0.0005, 0.05), share: float = 0.05) -> dict[str, Column]:
    """Alternative masks of a score: at its largest gap, the given flag, and a top share."""
    g = largest_gap(df, score, *gap)
    cut = top_cut(df, score, share)
    return {
        "gap": F.col(score) >= F.lit(g.threshold),
        "flag": F.col(flag),
        f"top_{share:g}": F.col(score) >= F.lit(cut),
    }


def rule_flag(df: DataFrame, condition: Column, out: str = "data_error") -> DataFrame:
    """Confirmed rows whose values are implausible."""
    return df.withColumn(out, F.col("confirmed") & _false(condition))


def risk_score(df: DataFrame, cols: Sequence[str], pct: float = 0.9, out: str = "risk_score", flag: str = "risk_signal") -> DataFrame:
    """Sum of population z-scores, and a flag at or above its percentile among plausible confirmed rows."""
    fit = moments(df, cols)
    total = F.lit(0.0)
    for c in cols:
        total = total + zscore(F.col(c), *fit[c])
    scored = df.withColumn(out, total)
    plausible = F.col("confirmed") & ~F.col("data_error")
    cut = percentile_threshold(scored, out, pct, plausible)
    hit = F.lit(False) if cut is None else _false(plausible & (F.col(out) >= F.lit(cut)))
    return scored.withColumn(flag, hit)


def classify(df: DataFrame, out: str = "classification") -> DataFrame:
    """First of data_error, risk_signal, rare_case among confirmed rows."""
    return df.withColumn(
        out,
        F.when(F.col("data_error"), "data_error").when(F.col("risk_signal"), "risk_signal")
        .when(F.col("confirmed"), "rare_case"),
    )


def outlier_type(df: DataFrame, noise: str, univariate: Sequence[str], out: str = "outlier_type") -> DataFrame:
    """First of collective (density noise), point (one dimension), contextual among confirmed rows."""
    single = _any({f: _false(F.col(f)) for f in univariate})
    return df.withColumn(
        out,
        F.when(~F.col("confirmed"), F.lit(None)).when(F.col(noise), "collective")
        .when(single, "point").otherwise("contextual"),
    )


def anomaly_report(df: DataFrame, features: Sequence[str], label: str, flags: Sequence[str], key: str = "row_id") -> DataFrame:
    """Confirmed rows with features, label, flags, scores and classes, farthest first."""
    cols = [
        key, *features, label, "n_methods", *flags,
        F.round("maha_dist2", 1).alias("maha_dist2"), F.round("risk_score", 2).alias("risk_score"),
        "classification", "outlier_type",
    ]
    return df.where("confirmed").select(*cols).orderBy(F.desc("maha_dist2"), key)


__all__ = [
    "anomaly_report", "classify", "consensus", "consensus_counts", "consensus_sensitivity", "flag_counts",
    "iqr_flags", "isolation_forest", "isolation_scores", "mahalanobis", "outlier_type", "risk_score",
    "rule_flag", "score_cutoffs", "zscore_flags",
]
