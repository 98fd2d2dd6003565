"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.session import cut_lineage

#: One word, and what separates words: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
#: Letters that are letters in every Unicode version, and signs; apostrophes are left out, since contractions begin with them.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ſ", r"!-&(-/:-@\[-`{-~"
#: A word and its signs, and those of one following line.
RUNS = re.compile(f"([{LETTERS}]+)([{SIGNS}]*)(?:\n([{LETTERS}]+)([{SIGNS}]*))?")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def keyed(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) alone, so that no other column of the input can clash."""
    return texts.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: later steps survive lost executors."""
    return cut_lineage(df)


def tasks_for(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def map_rows(df: DataFrame, rows: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``rows`` to each Arrow batch of ``df``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield rows(batch)

    return df.mapInPandas(run, schema)
