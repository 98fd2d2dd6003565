"""Column choice, type repair, encoding and binning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.functions import columns as X
from orebed.functions.orderstats import aggregate_row, exact_quantiles
from orebed.functions.stats import null_share, skew_corrected
from orebed.session import cut_lineage

LOOKUP_LITERALS = 200      # larger mappings are joined instead
ENCODED_VALUES = 100_000   # rows of an encoding table that may be broadcast


def is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def select_by_type(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the ``numeric`` or ``text`` columns; reads the schema only."""
    wanted = {"numeric": T.NumericType, "text": T.StringType}[kind]
    return [f.name for f in df.schema if isinstance(f.dataType, wanted) and f.name not in set(exclude)]


def find_column(df: DataFrame, name: str, fragment: str) -> str:
    """``name`` if present, else the first column holding ``fragment``, else the first."""
    if name in df.columns:
        return name
    hits = [c for c in df.columns if fragment.lower() in c.lower()]
    return (hits or df.columns)[0]


def parse_percent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text percents to doubles; numeric columns are left alone."""
    todo = {c: X.percent_to_double(F.col(c)) for c in cols if c in df.columns and is_text(df, c)}
    return df.withColumns(todo) if todo else df


def parse_term(df: DataFrame, col: str) -> DataFrame:
    """Text such as ``' 36 months'`` to a whole number."""
    if col in df.columns and is_text(df, col):
        return df.withColumn(col, X.months_to_long(F.col(col)))
    return df


def map_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Replace values by a constant mapping; values not in it become null."""
    out = out or col
    if len(mapping) <= LOOKUP_LITERALS:
        return df.withColumn(out, X.lookup(F.col(col), mapping))
    table = df.sparkSession.createDataFrame(list(mapping.items()), ["_from", "_to"])
    joined = df.join(table, df[col] == table["_from"], "left")
    return joined.withColumn(out, F.col("_to")).drop("_from", "_to")


def ordinal_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """1-based position of the value among the sorted distinct values."""
    out = out or col
    codes = distinct_ranks(df, col)
    small = codes.limit(ENCODED_VALUES + 1).count() <= ENCODED_VALUES
    codes = codes.select(F.col("value").alias("_value"), F.col("rank").alias("_rank"))
    joined = df.join(F.broadcast(codes) if small else codes, df[col] == codes["_value"], "left")
    return joined.withColumn(out, F.col("_rank")).drop("_value", "_rank")


def distinct_ranks(df: DataFrame, col: str) -> DataFrame:
    """Distinct values with their 1-based sorted position, sorted by value ranges."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).alias("value")).distinct()
    parts = cut_lineage(values.repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    offsets, seen = [], 0
    for part, n in sorted(parts.groupBy("part").count().collect()):
        offsets.append((part, seen))
        seen += n
    if not offsets:
        return values.withColumn("rank", F.lit(None).cast("bigint"))
    ahead = df.sparkSession.createDataFrame(offsets, "part int, ahead bigint")
    w = Window.partitionBy("part").orderBy("value")
    return parts.join(F.broadcast(ahead), "part").select(
        "value", (F.row_number().over(w) + F.col("ahead")).cast("bigint").alias("rank")
    )


def binary_encode(df: DataFrame, col: str, one: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, X.flag(F.col(col) == F.lit(one)))


def contains_flag(df: DataFrame, col: str, text: str, out: str) -> DataFrame:
    return df.withColumn(out, X.flag(F.contains(F.col(col), F.lit(text))))


def flag_and_fill(df: DataFrame, cols: Sequence[str], sentinel: float = 999) -> DataFrame:
    """``<c>_present`` flag, then the sentinel where the value is structurally absent."""
    flags = {f"{c}_present": F.col(c).isNotNull().cast("tinyint") for c in cols}
    fills = {c: F.coalesce(F.col(c), F.lit(sentinel).cast(df.schema[c].dataType)) for c in cols}
    return df.withColumns(flags).withColumns(fills) if cols else df


def prefix_label(df: DataFrame, col: str, prefix: str, out: str | None = None) -> DataFrame:
    """Put a fixed text before a label; null stays null."""
    return df.withColumn(out or col, F.concat(F.lit(prefix), F.col(col).cast("string")))


def matching_columns(
    columns: Sequence[str],
    names: Sequence[str] = (),
    prefixes: Sequence[str] = (),
    contains: Sequence[str] = (),
    suffixes: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> list[str]:
    """Names hit by any rule and not protected."""
    hit = []
    for c in columns:
        low = c.lower()
        if c not in keep and (
            c in names
            or any(low.startswith(p) for p in prefixes)
            or any(s in low for s in contains)
            or any(low.endswith(s) for s in suffixes)
        ):
            hit.append(c)
    return hit


def drop_by_rule(df: DataFrame, **rules) -> DataFrame:
    """Drop columns by name, prefix, fragment or suffix."""
    return df.drop(*matching_columns(df.columns, **rules))


def drop_constant(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns with at most one distinct non-null value."""
    cols = [c for c in df.columns if c not in set(keep)]
    same = aggregate_row(df, [F.min(c).eqNullSafe(F.max(c)) for c in cols])
    return df.drop(*[c for c, s in zip(cols, same) if s])


def drop_high_missing(df: DataFrame, pct: float = 40.0, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose share of nulls is strictly above ``pct`` percent."""
    cols = [c for c in df.columns if c not in set(keep)]
    shares = aggregate_row(df, [null_share(F.col(c)) for c in cols])
    return df.drop(*[c for c, s in zip(cols, shares) if s is not None and s * 100 > pct])


def dominant_shares(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Share of a value that holds a clear majority of rows, null counting as a value.

    A value held by clearly more than half of the rows is the median of any
    ordering. So one sketch of the median (of the values' hashes) names the
    only candidate and one counting pass measures it; columns are never
    grouped by value. Shares of one half and below come out as a lower bound.
    """
    cols = list(cols)
    # 52 bits, because the sketch computes in doubles
    hashed = {c: F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(c), F.lit(2**52))) for c in cols}
    medians = aggregate_row(df, [F.percentile_approx(hashed[c], 0.5) for c in cols])
    shares = aggregate_row(df, [
        F.greatest(
            null_share(F.col(c)),
            F.avg(F.coalesce(hashed[c] == F.lit(m), F.lit(False)).cast("double")),
        )
        for c, m in zip(cols, medians)
    ])
    return dict(zip(cols, shares))


def drop_quasi_constant(df: DataFrame, ratio: float = 0.99, protect: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose most frequent value covers at least ``ratio`` of rows."""
    if ratio <= 0.51:
        raise ValueError("a quasi-constant ratio must be a clear majority")
    cols = [c for c in df.columns if c not in set(protect) | set(keep)]
    shares = dominant_shares(df, cols)
    return df.drop(*[c for c in cols if (shares[c] or 0.0) >= ratio])


def split_nominal(df: DataFrame, cols: Sequence[str], key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """The table without the nominal columns, and the nominal columns by row key."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present), df.select(key, *present)


def quantile_bin(df: DataFrame, specs: Mapping[str, Sequence[str]], suffix: str = "_bin") -> DataFrame:
    """Equal-frequency bins, right-closed with the minimum included.

    Equal quantiles are merged into one bin and the last labels go unused.
    """
    by_size: dict[int, list[str]] = {}
    for c, labels in specs.items():
        by_size.setdefault(len(labels), []).append(c)
    out = {}
    for q, cols in by_size.items():
        edges = exact_quantiles(df, cols, [i / q for i in range(q + 1)])
        for c in cols:
            if edges[c][0] is None:
                out[c + suffix] = F.lit(None).cast("string")
                continue
            kept, labels = X.merge_edges(edges[c], specs[c])
            out[c + suffix] = X.right_closed_bin(F.col(c), kept, labels, lowest=True).cast("string")
    return df.withColumns(out)


def cut_bin(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence, out: str | None = None) -> DataFrame:
    """Fixed-edge bins, right-closed; values outside all edges become null."""
    return df.withColumn(out or col, X.right_closed_bin(F.col(col), edges, labels))


def winsorize(
    df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99, skew_thr: float = 1.0
) -> tuple[DataFrame, list[str]]:
    """Clip skewed columns to two quantiles, if the upper one exceeds the median."""
    skews = dict(zip(cols, aggregate_row(df, [skew_corrected(F.col(c)) for c in cols])))
    heavy = [c for c in cols if skews[c] is not None and abs(skews[c]) > skew_thr]
    q = exact_quantiles(df, heavy, [lo, 0.5, hi])
    done = [c for c in heavy if q[c][2] > q[c][1]]
    return df.withColumns({c: X.clip(F.col(c), q[c][0], q[c][2]) for c in done}) if done else df, done


def log_if_better(df: DataFrame, cols: Sequence[str], skew_thr: float = 1.0) -> tuple[DataFrame, list[str]]:
    """``log1p`` of non-negative skewed columns when it lowers the absolute skew."""
    found = aggregate_row(df, [
        e for c in cols
        for e in (
            skew_corrected(F.col(c)),
            skew_corrected(F.when(F.col(c) >= 0, F.log1p(F.col(c)))),
            # a null fails the sign test as a negative value does
            F.min(F.coalesce(F.col(c) >= 0, F.lit(False))),
        )
    ])
    done = []
    for i, c in enumerate(cols):
        raw, logged, allowed = found[3 * i : 3 * i + 3]
        if allowed and raw is not None and abs(raw) > skew_thr and abs(logged) < abs(raw):
            done.append(c)
    return df.withColumns({c: F.log1p(F.col(c)) for c in done}) if done else df, done


def moments(df: DataFrame, cols: Sequence[str], sample: bool = False) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation (population unless ``sample``) of each column."""
    std = F.stddev_samp if sample else F.stddev_pop
    vals = aggregate_row(df, [e for c in cols for e in (F.avg(c), std(c))])
    return {c: (vals[2 * i], vals[2 * i + 1]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero mean, unit population variance; constant columns become 0."""
    fit = moments(df, cols)
    return df.withColumns({c: X.zscore(F.col(c), *fit[c]) for c in cols if fit[c][0] is not None})


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def clip_upper(df: DataFrame, col: str, value: float) -> DataFrame:
    return df.withColumn(col, X.clip(F.col(col), None, value))


def format_metric(df: DataFrame, col: str, digits: int = 3, missing: str = "N/A") -> DataFrame:
    """Value with nulls as 0 for plotting, and a text label with nulls as ``missing``."""
    return df.withColumns({
        f"{col}_plot": F.coalesce(F.col(col), F.lit(0.0)),
        f"{col}_label": F.coalesce(F.replace(F.format_number(col, digits), F.lit(","), F.lit("")), F.lit(missing)),
    })


def any_flag(cols: Sequence[Column | str]) -> Column:
    """OR of boolean columns."""
    out = F.lit(False)
    for c in cols:
        out = out | (F.col(c) if isinstance(c, str) else c)
    return out


def keep_or_all(df: DataFrame, col: str, chosen) -> DataFrame:
    """Rows with one value of ``col``, or all rows for ``'all'``."""
    return df if chosen == "all" else df.where(F.col(col) == F.lit(chosen))
