"""The rule, segment and anomaly studies over prepared tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.config import DOMAIN_BINS, GRADE_ORDER
from orebed.operators import anomaly as A
from orebed.operators import clustering as K
from orebed.operators import columns as C
from orebed.operators import rules as R
from orebed.operators.align import align, flag_membership
from orebed.operators.nulls import drop_null_rows
from orebed.operators.profile import cluster_profile
from orebed.session import cut_lineage


def domain_items(original: DataFrame, basket: DataFrame, bins: Mapping = DOMAIN_BINS, key: str = "row_id") -> DataFrame:
    """Labelled categories of the loan domain; rows with a missing category are dropped."""
    cats = original
    used = [c for c in bins if c in original.columns]
    for c in used:
        cats = C.cut_bin(cats, c, *bins[c])
    if "grade" in original.columns:
        names = {float(v): f"Grade {k}" for k, v in GRADE_ORDER.items()}
        cats = C.map_values(cats.withColumn("grade", F.col("grade").cast("double")), "grade", names)
        used = [*used, "grade"]
    extra = basket.select(
        key,
        *([F.col("purpose")] if "purpose" in basket.columns else []),
        *([F.concat(F.lit("IntRate "), "int_rate_bin").alias("int_rate")] if "int_rate_bin" in basket.columns else []),
        *([F.concat(F.lit("Home "), "home_ownership").alias("home")] if "home_ownership" in basket.columns else []),
    )
    return drop_null_rows(align(cats.select(key, *used), extra, key, check=False))


def mine_rules(
    items: DataFrame, min_support: float = 0.04, max_len: int = 4, min_lift: float = 1.15,
    min_confidence: float = 0.5, key: str = "row_id",
) -> dict[str, DataFrame]:
    """Itemsets, all rules, the interesting rules and their statistics, from all rows."""
    baskets = R.to_baskets(items, [c for c in items.columns if c != key], key)
    itemsets = cut_lineage(R.frequent_itemsets(baskets, min_support, max_len))
    rules = cut_lineage(R.generate_rules(itemsets))
    kept = R.filter_rules(rules, min_lift, min_confidence)
    return {"itemsets": itemsets, "rules": rules, "kept": kept, "stats": R.rule_stats(rules, kept)}


def segment(
    scores: DataFrame, original: DataFrame, label: DataFrame, features: Sequence[str], bad: Column,
    k: int = 2, n_init: int = 10, seed: int = 42, key: str = "row_id",
) -> dict[str, DataFrame]:
    """K-means labels of all rows and the named profile of each segment."""
    cols = [c for c in scores.columns if c != key]
    labels = cut_lineage(K.assign_nearest(scores, K.kmeans_fit(scores, cols, k, n_init, seed, key=key)).select(key, "cluster"))
    joined = labels.join(original, key).join(label, key)
    profile = cluster_profile(joined, "cluster", features, bad)
    return {"labels": labels, "profile": K.name_clusters(profile, "cluster", "outcome_pct")}


def flag_anomalies(
    original: DataFrame, features: Sequence[str], implausible: Column, risk_columns: Sequence[str],
    noise: DataFrame | None = None, trees: int = 100, contamination: float = 0.01, seed: int = 42, key: str = "row_id",
) -> DataFrame:
    """Four methods, their consensus, and the class and type of every confirmed row."""
    df = A.zscore_flags(A.iqr_flags(original, features), features)
    df = A.mahalanobis(df, features)
    forest = A.isolation_forest(original, features, trees, contamination=contamination, seed=seed, key=key)
    df = df.join(forest, key, "left")
    df = A.consensus(df, ["flag_iqr", "flag_z", "flag_maha", "flag_if"])
    df = cut_lineage(A.rule_flag(df, implausible))
    df = A.classify(A.risk_score(df, risk_columns))
    if noise is None:
        df = df.withColumn("in_noise", F.lit(False))
    else:
        df = flag_membership(df, noise, "in_noise", key)
    return A.outlier_type(df, "in_noise", ["flag_iqr", "flag_z"])
