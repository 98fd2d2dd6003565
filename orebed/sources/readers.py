"""Table readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.functions.orderstats import aggregate_row


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    nrows: int | None = None,
    order_by: str | None = None,
    all_string: bool = False,
) -> DataFrame:
    """Read parquet or a CSV with header.

    Without a schema a CSV is inferred, which costs one more scan;
    ``all_string`` keeps every column as text. ``nrows`` takes the first rows
    of ``order_by``, or any rows when no order is given.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None and not all_string:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    if all_string and fmt != "csv":
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    if nrows is not None:
        df = (df.orderBy(order_by) if order_by else df).limit(nrows)
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_optional(
    spark: SparkSession,
    path: str,
    fallback: Callable[[], DataFrame] | None = None,
    fmt: str = "parquet",
) -> tuple[DataFrame | None, bool]:
    """The table and True when it exists, else the fallback and False."""
    if path_exists(spark, path):
        return read_table(spark, path, fmt), True
    return (fallback() if fallback else None), False


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null once, so that every aggregate skips it."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns
    ])


# Value ranges of the integer types, narrowest first.
INTEGER_RANGES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31))


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast doubles to float and whole numbers to the smallest type that holds them."""
    whole = [f.name for f in df.schema if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    bounds = aggregate_row(df, [e for c in whole for e in (F.min(c), F.max(c))])
    target = {}
    for i, c in enumerate(whole):
        lo, hi = bounds[2 * i], bounds[2 * i + 1]
        for name, limit in INTEGER_RANGES:
            if lo is not None and -limit <= lo and hi < limit:
                target[c] = name
                break
    for f in df.schema:
        if isinstance(f.dataType, T.DoubleType):
            target[f.name] = "float"
    return df.select(*[
        F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns
    ])
