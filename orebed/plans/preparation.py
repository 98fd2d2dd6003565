"""Cleaning, transformation, selection and reduction of a wide raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orebed.config import MiningConfig
from orebed.operators import columns as C
from orebed.operators import nulls as N
from orebed.operators.align import align
from orebed.operators.correlation import pair_correlations
from orebed.operators.reduction import pca_reduce, project_2d
from orebed.operators.selection import hybrid_subset, mutual_info_knn, redundant_columns
from orebed.session import cut_lineage


def clean(df: DataFrame, cfg: MiningConfig, key: str = "row_id") -> tuple[DataFrame, DataFrame | None]:
    """Repaired, null-free, de-duplicated features, and the outcome label by row key.

    The order of the stages matters: constants and leakage go before flags are
    made, and structural nulls are filled before null shares are judged.
    """
    held = [c for c in (key, cfg.label) if c in df.columns]
    df = C.parse_percent(C.parse_term(df, cfg.term_column), cfg.percent_columns)
    if cfg.years_column in df.columns and C.is_text(df, cfg.years_column):
        df = C.map_values(df, cfg.years_column, cfg.years_map)
    df = C.drop_by_rule(C.drop_constant(df, held), names=cfg.id_columns, keep=held)
    df = C.drop_by_rule(df, names=cfg.leakage_columns, prefixes=cfg.leakage_prefixes, keep=held)
    df = C.flag_and_fill(df, C.matching_columns(df.columns, prefixes=[cfg.structural_prefix]), cfg.sentinel)
    if cfg.joint_column in df.columns:
        df = C.contains_flag(df, cfg.joint_column, cfg.joint_text, "is_joint").drop(cfg.joint_column)
        held = [*held, "is_joint"]
    df = C.drop_by_rule(df, contains=cfg.joint_fragments, prefixes=cfg.joint_prefixes, keep=held)
    df = C.drop_high_missing(df, cfg.max_missing_pct, held)
    if cfg.group_impute and set(cfg.group_impute) <= set(df.columns):
        df = N.impute_group_mean(df, *cfg.group_impute)
    df = N.impute_remaining(df, [key, cfg.label])
    if cfg.label in df.columns:
        df = N.require_label(df, cfg.label)
    df = cut_lineage(N.dedup_rows(df, key))
    if cfg.label not in df.columns:
        return df, None
    return df.drop(cfg.label), df.select(key, cfg.label)


def transform(df: DataFrame, cfg: MiningConfig, key: str = "row_id") -> dict[str, DataFrame]:
    """Encoded features: ``original`` values, ``transformed``, ``scaled``, and the ``basket`` table.

    Bins and the original snapshot are taken before clipping and logs.
    """
    _, nominal = C.split_nominal(df, cfg.nominals, key)
    for c, mapping in cfg.grade_columns.items():
        if c in df.columns and C.is_text(df, c):
            df = C.map_values(df, c, mapping)
    for c in cfg.ordinal_text:
        if c in df.columns and C.is_text(df, c):
            df = C.ordinal_encode(df, c)
    for c, one in cfg.binary_text.items():
        if c in df.columns and C.is_text(df, c):
            df = C.binary_encode(df, c, one)
    df = df.drop(*cfg.dropped_nominals)
    df = df.drop(*[c for c in C.select_by_type(df, "text") if c != key])
    original = cut_lineage(df)

    specs = {c: labels for c, labels in cfg.quantile_bins.items() if c in original.columns}
    bins = C.quantile_bin(original, specs) if specs else original
    basket = align(bins.select(key, *[f"{c}_bin" for c in specs]), nominal, key, check=False)

    fixed = set(cfg.ordinal_columns) | {c for c in original.columns if c.endswith("_present")} | {key}
    free = [c for c in C.select_by_type(original, "numeric") if c not in fixed]
    df, _ = C.winsorize(original, free, *cfg.winsor, cfg.winsor_skew)
    df, _ = C.log_if_better(df, free, cfg.log_skew)
    df = cut_lineage(C.drop_quasi_constant(df, cfg.quasi_constant, cfg.protected, [key]))
    features = [c for c in df.columns if c != key]
    return {"original": original, "transformed": df, "scaled": C.standardize(df, features), "basket": basket}


def select(tables: dict[str, DataFrame], cfg: MiningConfig, key: str = "row_id") -> tuple[list[str], DataFrame]:
    """Final feature names and the mutual information table."""
    df = tables["transformed"]
    features = [c for c in df.columns if c != key]
    pairs = pair_correlations(df, features)
    lost = redundant_columns(pairs, cfg.max_correlation, cfg.priority, cfg.target)
    kept = [c for c in features if c not in lost]
    inputs = [c for c in kept if c != cfg.target]
    # scaled features with the class values of the unscaled target
    sample = tables["scaled"].select(key, *inputs).join(df.select(key, cfg.target), key)
    mi = mutual_info_knn(sample, inputs, cfg.target, cfg.mi_neighbors, cfg.mi_sample, cfg.seed, key)
    ranked = [r["feature"] for r in mi.collect()]
    corr = {(a, b): r for a, b, r in pairs}
    core = [c for c in cfg.core if c in kept]
    return hybrid_subset(core, ranked, corr, cfg.n_features, cfg.guard_correlation), mi


def prepare(raw: DataFrame, cfg: MiningConfig, key: str = "row_id") -> dict:
    """All artifacts of the preparation study, keyed by name and joined by row key."""
    features, label = clean(raw, cfg, key)
    tables = transform(features, cfg, key)
    final, mi = select(tables, cfg, key)
    scaled = cut_lineage(tables["scaled"].select(key, *final))
    scores, fit = pca_reduce(scaled, final, cfg.pca_variance, key)
    return {
        "cleaned": tables["transformed"].select(key, *final),
        "original": tables["original"].select(key, *final),
        "scaled": scaled, "pca": scores, "plane": project_2d(scaled, final, key, fit),
        "basket": tables["basket"], "label": label, "mi": mi, "components": fit, "features": final,
    }


