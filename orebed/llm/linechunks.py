"""Line deduplication by content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines chooses where a chunk
ends, so chunks of a shared passage are the same wherever the passage stands. A
line of ``LONG_WORDS`` words or more is a chunk of its own. Chunks of two or more
lines with words, and long lines, are compared over all documents: grouping by
key and by the text itself compares them byte by byte. Of equal chunks the first,
by document id and place, stays and all others are removed.

Defined results: a null text stays null; an empty text, and one without eligible
chunks, is unchanged; rows with the same id and the same text are one document
and end up alike; null ids count as largest; should different texts ever share a
key they all stay; an empty table gives an empty result; other columns are kept.

Chunks leave most of a repeated passage of short lines in the text. ``dedup_passages``
removes all of it: besides chunks it compares passages, the shortest runs of whole
lines from each line and up to each line that hold ``LONG_WORDS`` words. A run that is
repeated with that many words consists of such passages, wherever its lines break. An
occurrence that overlaps the first one stays, so the words of every passage do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

LONG_WORDS = 50
LEAST_WORDS = 8  # of a chunk of several lines
ONE_IN = 4  # lines that end a chunk, on average
MULTIPLIER = 1_000_003


def line_hash(line: str) -> int:
    return int(hashlib.md5(line.encode()).hexdigest()[:8], 16)


def chunks(text: str) -> list[tuple[int, int, bool]]:
    """(first line, lines, eligible) of the chunks of a text, in order."""
    lines = text.split("\n")
    sizes = [len(line.encode().split()) for line in lines]
    out, start, before = [], 0, 0
    for i, line in enumerate(lines):
        here = line_hash(line)
        ends = (before * MULTIPLIER + here) % ONE_IN == 0 or sizes[i] >= LONG_WORDS
        if i + 1 == len(lines) or ends or sizes[i + 1] >= LONG_WORDS:
            held = sizes[start : i + 1]
            eligible = sizes[i] >= LONG_WORDS or sum(map(bool, held)) >= 2 and sum(held) >= LEAST_WORDS
            out.append((start, i + 1 - start, eligible))
            start = i + 1
        before = here
    return out


def passages(sizes: list[int]) -> set[tuple[int, int]]:
    """(first line, lines) of the shortest runs with LONG_WORDS words from and up to each line."""
    out, end, held = set(), 0, 0
    for start, size in enumerate(sizes):
        while end < len(sizes) and held < LONG_WORDS:
            held += sizes[end]
            end += 1
        if held < LONG_WORDS:
            break
        out.add((start, end - start))
        held -= size
    start = held = 0
    for i, size in enumerate(sizes):
        held += size
        while held - sizes[start] >= LONG_WORDS:
            held -= sizes[start]
            start += 1
        if held >= LONG_WORDS:
            out.add((start, i + 1 - start))
    return out


def _row_key():
    return F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit("row"), "doc_id", "text").alias("k2")


def eligible_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k1, k2, start, n_lines, key, chunk): every eligible chunk with its text; a narrow pass."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    rows = rows.select("doc_id", *_row_key(), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "k1", "k2", "start", "n_lines", "key", "chunk"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for doc, k1, k2, text in zip(batch["doc_id"], batch["k1"], batch["k2"], batch["text"], strict=True):
                lines = text.split("\n")
                for start, n, eligible in chunks(text):
                    if eligible:
                        chunk = "\n".join(lines[start : start + n])
                        found.append((doc, k1, k2, start, n, hashlib.blake2b(chunk.encode(), digest_size=16).digest(), chunk))
            out = pd.DataFrame(found, columns=columns)
            out["doc_id"] = out["doc_id"].astype(batch["doc_id"].dtype)
            yield out

    return rows.mapInPandas(run, f"doc_id {kind}, k1 long, k2 long, start int, n_lines int, key binary, chunk string")


@F.pandas_udf(StringType())
def _without(text: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.Series:
    """Texts without the lines of the removed chunks."""
    out = []
    for t, first, n in zip(text, starts, sizes, strict=True):
        if t is None:
            out.append(None)
            continue
        lines = t.split("\n")
        gone = set()
        for a, b in zip(first, n, strict=True):
            gone.update(range(a, a + b))
        out.append("\n".join(line for i, line in enumerate(lines) if i not in gone))
    return pd.Series(out, dtype="object")


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, starts, sizes): the chunks to remove from each document that has any.

    Texts are only shuffled once, combined in the map tasks, to be grouped;
    deciding on each occurrence needs their keys alone.
    """
    found = eligible_chunks(docs, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "start")
    texts = found.groupBy("key", "chunk").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    keys = texts.groupBy("key").agg(F.count("*").alias("texts"), F.max("n").alias("n"), F.first("first").alias("first"))
    repeated = keys.where("texts = 1 and n > 1").select("key", "first")
    gone = found.drop("chunk").join(repeated, "key").where(place != F.col("first"))
    # rows with one id and text list a chunk once each
    return gone.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("start", "n_lines"))).alias("gone")).select(
        "k1", "k2", F.col("gone.start").alias("starts"), F.col("gone.n_lines").alias("sizes"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as (row, text, removed_chunks, removed_lines); ``row`` holds the columns as they were."""
    decided = removals(docs)
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.col("text")).select("row", *_row_key())
    joined = whole.join(decided, ["k1", "k2"], "left")
    clean = _without.asNondeterministic()(F.when(F.col("starts").isNotNull(), F.col("row.text")), "starts", "sizes")
    told = joined.select("row", "starts", "sizes", clean.alias("clean"))
    return told.select(
        "row", F.when(F.col("starts").isNull(), F.col("row.text")).otherwise(F.col("clean")).alias("text"),
        F.coalesce(F.size("starts"), F.lit(0)).cast("long").alias("removed_chunks"),
        F.when(F.col("starts").isNull(), F.lit(0)).otherwise(F.aggregate("sizes", F.lit(0), lambda a, x: a + x))
        .cast("long").alias("removed_lines"),
    )


def keep_lines(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without repeated chunks; a document that lost its last word goes.

    ``n_chars``, where there is such a column, follows the new text.
    """
    done = dedup_lines(docs)
    stays = (F.col("removed_chunks") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = F.col("removed_chunks") > 0
    return done.where(stays).select(*[
        F.col("text").alias(c) if c == "text"
        else F.when(changed, F.length("text").cast("long")).otherwise(F.col("row")[c]).alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c) for c in docs.columns])


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


def passage_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, start, n_lines, key): every passage and eligible chunk, without its text; a narrow pass."""
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", *_row_key(), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "k1", "k2", "start", "n_lines", "key"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for doc, k1, k2, text in zip(batch["doc_id"], batch["k1"], batch["k2"], batch["text"], strict=True):
                lines = text.split("\n")
                spans = passages([len(line.encode().split()) for line in lines])
                spans.update((start, n) for start, n, eligible in chunks(text) if eligible)
                for start, n in spans:
                    found.append((doc, k1, k2, start, n, _digest("\n".join(lines[start : start + n]))))
            out = pd.DataFrame(found, columns=columns)
            out["doc_id"] = out["doc_id"].astype(batch["doc_id"].dtype)
            yield out

    return rows.mapInPandas(run, f"doc_id {kind}, k1 long, k2 long, start int, n_lines int, key binary")


def _texts(rows: DataFrame) -> DataFrame:
    """(key, chunk) of the spans listed beside each row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for text, spans in zip(batch["row"].field("text"), batch["spans"], strict=True):
                lines = text.as_py().split("\n") if spans.is_valid else []
                for span in spans.as_py() or []:
                    keys.append(span["key"])
                    found.append("\n".join(lines[span["start"] : span["start"] + span["n_lines"]]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], ["key", "chunk"])

    return rows.select("row", "spans").mapInArrow(run, "key binary, chunk string")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, spans): of each document its spans whose key is met again, and whether a first one stands apart before."""
    found = passage_keys(docs)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "start")
    repeated = found.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    apart = (F.col("k1") != F.col("first.k1")) | (F.col("k2") != F.col("first.k2")) | ~F.col("doc_id").eqNullSafe(
        F.col("first.doc_id")) | (F.col("start") >= F.col("first.start") + F.col("n_lines"))
    # rows with one id and text list a span once each
    met = found.join(repeated, "key").select("k1", "k2", F.struct("start", "n_lines", "key", apart.alias("apart")).alias("span"))
    return met.groupBy("k1", "k2").agg(F.collect_set("span").alias("spans"))


def dedup_passages(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as (row, text, removed_lines) without repeated passages and chunks.

    Only keys are compared over all documents; the texts of repeated keys are then
    compared byte by byte, from the same shuffled rows that are cleaned, and a key
    with different texts removes nothing.
    """
    whole = docs.select(F.struct("*").alias("row"), "doc_id", "text").select("row", *_row_key())
    joined = whole.join(repeated_spans(docs), ["k1", "k2"], "left")
    texts = _texts(joined).groupBy("key", "chunk").agg(F.lit(1))
    unlike = texts.groupBy("key").count().where("count > 1").agg(F.collect_set("key").alias("unlike"))
    gone = F.filter("spans", lambda s: s.apart & ~F.array_contains("unlike", s.key))
    told = joined.crossJoin(F.broadcast(unlike)).select("row", F.when(F.size(gone) > 0, gone).alias("gone"))
    told = told.select("row", F.col("gone.start").alias("starts"), F.col("gone.n_lines").alias("sizes"))
    clean = _without.asNondeterministic()(F.when(F.col("starts").isNotNull(), F.col("row.text")), "starts", "sizes")
    told = told.select("row", "starts", "sizes", clean.alias("clean"))
    lines = F.flatten(F.zip_with("starts", "sizes", lambda a, n: F.sequence(a, a + n - 1)))
    return told.select(
        "row", F.when(F.col("starts").isNull(), F.col("row.text")).otherwise(F.col("clean")).alias("text"),
        F.when(F.col("starts").isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(lines))).cast("long").alias("removed_lines"),
    )
