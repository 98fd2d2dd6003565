"""Profiling aggregations over wide tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.columns import zscore
from orebed.functions.orderstats import aggregate_row, exact_quantiles
from orebed.functions.stats import kurt_corrected, null_share, skew_corrected
from orebed.operators.columns import moments
from orebed.operators.nulls import long_values


def _rows(df: DataFrame, rows: list, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def type_profile(df: DataFrame) -> DataFrame:
    """Number of columns per data type."""
    return (
        _rows(df, df.dtypes, "feature string, dtype string")
        .groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns")).orderBy(F.desc("n_columns"), "dtype")
    )


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    vals = aggregate_row(df, [
        e for c in cols
        for e in (F.count(c), F.avg(c), F.stddev_samp(c),
                  F.min(c).cast("double"), F.max(c).cast("double"))
    ])
    rows = []
    for i, c in enumerate(cols):
        n, mean, std, lo, hi = vals[5 * i : 5 * i + 5]
        rows.append((c, n, mean, std, lo, *q[c], hi))
    return _rows(df, rows, (
        "feature string, n bigint, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double"
    ))


def iqr_outlier_pct(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Percentage of non-null values outside the Tukey fences."""
    q = exact_quantiles(df, cols, [0.25, 0.75])
    exprs = []
    for c in cols:
        q1, q3 = q[c]
        if q1 is None:
            exprs.append(F.lit(None).cast("double"))
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        exprs.append(F.avg(((F.col(c) < lo) | (F.col(c) > hi)).cast("double")) * 100)
    # max() turns a bare literal into an aggregate
    vals = aggregate_row(df, [F.max(e) if q[c][0] is None else e for c, e in zip(cols, exprs)])
    return _rows(df, list(zip(cols, vals)), "feature string, outlier_pct double")


def shape_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Corrected skewness and kurtosis per column."""
    vals = aggregate_row(df, [e for c in cols for e in (skew_corrected(F.col(c)), kurt_corrected(F.col(c)))])
    rows = [(c, vals[2 * i], vals[2 * i + 1]) for i, c in enumerate(cols)]
    return _rows(df, rows, "feature string, skew double, kurtosis double")


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Descriptive statistics, shape, null share and outlier share, most skewed first."""
    missing = aggregate_row(df, [null_share(F.col(c)) * 100 for c in cols])
    nulls = _rows(df, list(zip(cols, missing)), "feature string, missing_pct double")
    return (
        describe_numeric(df, cols).join(shape_profile(df, cols), "feature")
        .join(nulls, "feature").join(iqr_outlier_pct(df, cols), "feature")
        .orderBy(F.desc("skew"), "feature")
    )


def skew_ranking(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns by absolute corrected skewness."""
    vals = aggregate_row(df, [skew_corrected(F.col(c)) for c in cols])
    return _rows(df, list(zip(cols, vals)), "feature string, skew double").orderBy(
        F.desc(F.abs("skew")), "feature"
    )


def categorical_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values, top value with its share of all rows, and null share per column."""
    counted = long_values(df, cols)
    known = F.col("value").isNotNull()
    return (
        counted.groupBy("col").agg(
            F.count_if(known).alias("n_unique"),
            F.min(F.when(known, F.struct(-F.col("n"), F.col("value")))).alias("best"),
            F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
            F.sum("n").alias("total"),
        )
        .select(
            F.col("col").alias("feature"), "n_unique", F.col("best.value").alias("top"),
            F.round(-F.col("best.col1") / F.col("total") * 100, 2).alias("top_freq_pct"),
            F.round(F.col("nulls") / F.col("total") * 100, 2).alias("missing_pct"),
        )
        .orderBy("n_unique", "feature")
    )


def value_counts_topk(df: DataFrame, cols: Sequence[str], k: int = 25, max_unique: int | None = 25) -> DataFrame:
    """Up to ``k`` most frequent values of the columns with few distinct values."""
    counted = long_values(df, cols).where("value is not null")
    if max_unique is not None:
        few = counted.groupBy("col").agg(F.count(F.lit(1)).alias("u")).where(F.col("u") <= max_unique)
        counted = counted.join(few.select("col"), "col", "left_semi")
    w = Window.partitionBy("col").orderBy(F.desc("n"), "value")
    return (
        counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        .select(F.col("col").alias("feature"), "value", "n", "rank")
    )


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 40) -> DataFrame:
    """Counts of equal-width bins between the minimum and maximum; the last bin is closed."""
    ends = aggregate_row(df, [e for c in cols for e in (F.min(c).cast("double"), F.max(c).cast("double"))])
    cells = []
    for i, c in enumerate(cols):
        lo, hi = ends[2 * i], ends[2 * i + 1]
        if lo is None:
            continue
        x = F.col(c).cast("double")
        if lo == hi:
            bucket = F.when(x.isNotNull(), F.lit(bins // 2 + 1))
        else:
            # a first guess, moved by one where rounding put it beside its edges
            width = (hi - lo) / bins
            guess = F.least(F.floor((x - lo) / width), F.lit(bins - 1))
            edge = lambda b: lo + b * width
            bucket = (
                F.when(x.isNull(), F.lit(None))  # least() would skip the null
                .when(x < edge(guess), guess - 1)
                .when((x >= edge(guess + 1)) & (guess < bins - 1), guess + 1).otherwise(guess) + 1
            )
        cells.append(F.struct(F.lit(c).alias("feature"), bucket.cast("int").alias("bucket")))
    return (
        df.select(F.explode(F.array(*cells)).alias("x")).where("x.bucket is not null")
        .groupBy("x.feature", "x.bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def boxplot_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and number of fliers."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    used = [c for c in cols if q[c][0] is not None]
    exprs = []
    for c in used:
        lo = q[c][0] - k * (q[c][2] - q[c][0])
        hi = q[c][2] + k * (q[c][2] - q[c][0])
        x = F.col(c).cast("double")
        exprs += [F.min(F.when(x >= lo, x)), F.max(F.when(x <= hi, x)), F.count_if((x < lo) | (x > hi))]
    vals = aggregate_row(df, exprs)
    rows = [
        (c, vals[3 * i], *q[c], vals[3 * i + 1], vals[3 * i + 2]) for i, c in enumerate(used)
    ]
    return _rows(df, rows, (
        "feature string, whisker_low double, q25 double, q50 double, q75 double, "
        "whisker_high double, fliers bigint"
    ))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Row count and percentage of each value; the total is one row, from the same grouped counts."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def scalars(df: DataFrame, col: str) -> DataFrame:
    """One row: minimum, maximum, mean and exact median."""
    median = exact_quantiles(df, [col], [0.5])[col][0]
    return df.agg(
        F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("mean"),
    ).withColumn("median", F.lit(median).cast("double"))


def rate_by(df: DataFrame, outcome: Column, masks: dict[str, Column]) -> DataFrame:
    """Outcome percentage of all rows and of each masked subset, with lift over all rows."""
    y = outcome.cast("double")
    names = ["all", *masks]
    exprs = [F.count(F.lit(1)), F.avg(y) * 100]
    for m in masks.values():
        exprs += [F.count_if(m), F.avg(F.when(m, y)) * 100]
    vals = aggregate_row(df, exprs)
    rows = []
    for i, name in enumerate(names):
        n, rate = vals[2 * i], vals[2 * i + 1]
        lift = rate / vals[1] if rate is not None and vals[1] else None
        rows.append((name, n, rate, lift))
    return _rows(df, rows, "subset string, n bigint, rate_pct double, lift double")


def crosstab(df: DataFrame, a: str, b: str, normalize: bool = False) -> DataFrame:
    """Counts per pair of values in long form, optionally with the row share."""
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    totals = counts.groupBy(F.col(a).alias("_a")).agg(F.sum("n").alias("_total"))
    return counts.join(totals, counts[a].eqNullSafe(totals["_a"])).select(
        a, b, "n", (F.col("n") / F.col("_total") * 100).alias("row_pct")
    )


def crosstab_wide(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    """Counts with one column per listed value of ``b``."""
    return df.groupBy(a).pivot(b, list(values)).agg(F.count(F.lit(1))).fillna(0)


def cluster_profile(df: DataFrame, by: str, cols: Sequence[str], outcome: Column, digits: int = 1) -> DataFrame:
    """Rounded means, size percentage and outcome percentage per group."""
    total = df.count()
    return df.groupBy(by).agg(
        *[F.round(F.avg(c), digits).alias(c) for c in cols],
        F.round(F.count(F.lit(1)) / F.lit(float(total)) * 100, digits).alias("size_pct"),
        F.round(F.avg(outcome.cast("double")) * 100, digits).alias("outcome_pct"),
    )


def profile_zscore(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Group means as deviations from the population in sample standard deviations."""
    fit = moments(df, cols, sample=True)
    return df.groupBy(by).agg(*[zscore(F.avg(c), *fit[c]).alias(c) for c in cols])


def compare_groups(df: DataFrame, mask: Column, cols: Sequence[str], names: tuple[str, str] = ("rest", "group")) -> DataFrame:
    """Mean of each column outside and inside a subset."""
    vals = aggregate_row(df, [
        e for c in cols for e in (F.avg(F.when(~mask, F.col(c))), F.avg(F.when(mask, F.col(c))))
    ])
    rows = [(c, vals[2 * i], vals[2 * i + 1]) for i, c in enumerate(cols)]
    return _rows(df, rows, f"feature string, {names[0]} double, {names[1]} double")


def funnel(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows left after each stage and their percentage of the first stage."""
    spark = stages[0][1].sparkSession
    counts = None
    for i, (name, df) in enumerate(stages):
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i + 1).alias("step"), F.lit(name).alias("stage"), "rows"
        )
        counts = row if counts is None else counts.unionByName(row)
    rows = sorted(counts.collect())
    base = rows[0]["rows"]
    return spark.createDataFrame(
        [(r["step"], r["stage"], r["rows"], 100.0 * r["rows"] / base if base else None) for r in rows],
        "step int, stage string, rows bigint, pct_initial double",
    )
