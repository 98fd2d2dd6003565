"""Joins between artifacts that share a row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(a: DataFrame, b: DataFrame, key: str = "row_id", check: bool = True) -> DataFrame:
    """One-to-one join on the row key; optionally fail when the row counts differ."""
    joined = a.join(b, key)
    if check:
        na, nb, nj = a.count(), b.count(), joined.count()
        if not na == nb == nj:
            raise ValueError(f"rows do not align: {na}, {nb}, joined {nj}")
    return joined


def take_rows(df: DataFrame, ids: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows whose key occurs in ``ids``."""
    return df.join(ids.select(key), key, "left_semi")


def flag_membership(df: DataFrame, ids: DataFrame, out: str, key: str = "row_id") -> DataFrame:
    """Boolean column: does the key occur in ``ids``?"""
    marks = ids.select(key).distinct().withColumn(out, F.lit(True))
    return df.join(marks, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def cross_reference(members: DataFrame, flags: DataFrame, count: str = "n_methods", key: str = "row_id") -> DataFrame:
    """One row: members of one method that at least one or two other methods flag."""
    joined = members.select(key).join(flags.select(key, count), key)
    n = F.col(count)
    return joined.agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if(n >= 1).alias("flagged_1"),
        (F.avg((n >= 1).cast("double")) * 100).alias("flagged_1_pct"),
        F.count_if(n >= 2).alias("flagged_2"),
    )


def lookup_join(df: DataFrame, table: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Dictionary join; the optimizer broadcasts the table when its size allows."""
    return df.join(table, on, how)
