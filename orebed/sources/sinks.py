"""Result writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def save_outputs(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each artifact under ``folder`` and return the paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(paths[name])
    return paths


def write_labels(df: DataFrame, path: str, label: str, key: str = "row_id", noise: int | None = None) -> None:
    """Write row key and label, with a noise flag when a noise label is given."""
    out = df.select(key, label)
    if noise is not None:
        out = out.withColumn("is_noise", (F.col(label) == noise).cast("int"))
    out.write.mode("overwrite").parquet(path)


def write_result(df: DataFrame, path: str, order: Sequence[Column | str], fmt: str = "parquet") -> None:
    """Write a result table in a global order (range-split, not one task)."""
    writer = df.orderBy(*order).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
