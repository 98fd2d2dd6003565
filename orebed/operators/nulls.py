"""Missing values and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.functions.orderstats import aggregate_row, exact_quantile, exact_quantiles
from orebed.functions.stats import null_share
from orebed.operators.columns import select_by_type


def impute_group_mean(df: DataFrame, col: str, by: str) -> DataFrame:
    """Fill with the mean of the row's group, then with the median of the filled column.

    The group means are pre-aggregated and joined back, so that a group holding
    a large share of the rows is never collected as a window partition.
    """
    means = df.groupBy(F.col(by).alias("_by")).agg(F.avg(col).alias("_mean"))
    filled = (
        df.join(means, df[by] == means["_by"], "left")
        .withColumn(col, F.coalesce(F.col(col), F.col("_mean"))).drop("_by", "_mean")
    )
    median = exact_quantile(filled, col, 0.5)
    return filled if median is None else filled.fillna({col: median})


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls of numeric columns with the exact median."""
    medians = exact_quantiles(df, list(cols), [0.5])
    fill = {c: m[0] for c, m in medians.items() if m[0] is not None}
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in fill.items()
    }) if fill else df


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, value as text, n): row counts of every value, null included."""
    return (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols
        ])).alias("x"))
        .groupBy("x.col", "x.value").agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent non-null value of each text column, the smallest on ties."""
    rows = (
        long_values(df, cols).where("value is not null").groupBy("col")
        .agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("m")).collect()
    )
    return {r["col"]: r["m"]["value"] for r in rows}


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    found = modes(df, cols)
    return df.fillna(found) if found else df


def drop_null_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(cols) if cols else None)


def require_label(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull())


def dedup_rows(df: DataFrame, key: str = "row_id") -> DataFrame:
    """One row per distinct content (nulls equal), keeping the smallest key.

    Grouping pre-aggregates before the shuffle, so a row repeated many times
    leaves each map task once.
    """
    data = [c for c in df.columns if c != key]
    return df.groupBy(*data).agg(F.min(key).alias(key)).select(*df.columns)


def count_nulls(df: DataFrame) -> DataFrame:
    """One row: total number of null cells."""
    per_column = [F.count_if(F.col(c).isNull()) for c in df.columns]
    return df.agg(sum(per_column[1:], per_column[0]).cast("bigint").alias("total_missing"))


def missing_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """Null count and percentage of the columns that have nulls, worst first."""
    cols = df.columns
    counts = aggregate_row(df, [F.count(F.lit(1))] + [F.count_if(F.col(c).isNull()) for c in cols])
    table = df.sparkSession.createDataFrame(
        [(c, n, counts[0]) for c, n in zip(cols, counts[1:])],
        "feature string, missing_count bigint, total bigint",
    )
    return (
        table.where("missing_count > 0")
        .select("feature", "missing_count",
                F.round(F.col("missing_count") / F.col("total") * 100, digits).alias("missing_pct"))
        .orderBy(F.desc("missing_pct"), "feature")
    )


def classify_missing(profile: DataFrame, rules: Sequence[tuple[str, str]], other: str, name: str = "feature") -> DataFrame:
    """Mechanism by the first pattern that fits the lower-cased column name."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, label in rules:
        out = out.when(F.lower(F.col(name)).rlike(pattern), F.lit(label))
    return profile.withColumn("mechanism", out.otherwise(F.lit(other)))


def missing_bands(profile: DataFrame, total_columns: int) -> DataFrame:
    """One row: columns without nulls and in the bands above 50, 20 to 50, up to 20 percent."""
    p = F.col("missing_pct")
    return profile.agg(
        (F.lit(total_columns) - F.count(F.lit(1))).cast("bigint").alias("complete"),
        F.count(F.lit(1)).alias("with_missing"),
        F.count_if(p > 50).alias("over_50"),
        F.count_if((p > 20) & (p <= 50)).alias("from_20_to_50"),
        F.count_if(p <= 20).alias("up_to_20"),
    )


def mechanism_counts(classified: DataFrame) -> DataFrame:
    """Columns per mechanism, named by the text before the dash."""
    return (
        classified.groupBy(F.split("mechanism", " —")[0].alias("mechanism"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "mechanism")
    )


def conditional_null_rate(df: DataFrame, cols: Sequence[str], predicate: Column) -> DataFrame:
    """Null percentage of each column among rows that satisfy a predicate and among the rest."""
    hit = F.coalesce(predicate, F.lit(False))
    vals = aggregate_row(df, [
        e for c in cols
        for e in (
            F.avg(F.when(hit, F.col(c).isNull().cast("double"))) * 100,
            F.avg(F.when(~hit, F.col(c).isNull().cast("double"))) * 100,
        )
    ])
    return df.sparkSession.createDataFrame(
        [(c, vals[2 * i], vals[2 * i + 1]) for i, c in enumerate(cols)],
        "feature string, null_pct_if double, null_pct_else double",
    )


def impute_remaining(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Median for numeric and mode for text columns that still hold nulls."""
    cols = [c for c in df.columns if c not in set(keep)]
    shares = dict(zip(cols, aggregate_row(df, [null_share(F.col(c)) for c in cols])))
    open_ = {c for c in cols if shares[c]}
    numeric = [c for c in select_by_type(df, "numeric") if c in open_]
    text = [c for c in select_by_type(df, "text") if c in open_]
    df = impute_median(df, numeric) if numeric else df
    return impute_mode(df, text) if text else df
