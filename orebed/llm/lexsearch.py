"""Ranked lexical search of every benchmark item over all documents, pruned by a dual-tree search.

Scoring (integer BM25 form): a term's weight is ``w = floor(1000 ln((2N+2)/(2df+1)))``. A document's
length norm is ``m = 100 - 75 + (75 n N) div L``. Its coordinate for a term is
``c = (10**9 tf) div (1000 tf + 8 m)``. An item's coordinate is ``q = (occurrences in the item) * w``.
The score is the sum of ``q * c`` over shared terms.

Method (dual-tree search): documents form a hierarchy. Buckets group documents by a hash of their
heaviest term; each bucket splits into leaves of about ``LEAF`` documents. Items are dealt into
blocks of about ``ITEM_BLOCK``, the leaves of the item tree being single items. Every node keeps
its coordinate maxima per term: the largest ``c`` in a document node, the largest ``q`` in an item
node. For a node pair, the sum of ``max q * max c`` bounds the score of every (item, document) pair
below it. Seeds come from the exactly scored documents of each block's best-bounded leaves. An
item's threshold is its tenth seeded score (or 1, where fewer than ten documents score above 0); a
block's is the weakest of its items. (Item block, bucket) pairs whose bound lies below the block's
threshold are pruned whole. Below the live ones, (item, leaf) pairs are pruned against the item's
threshold. This is exact: every pruned
document scores below the tenth score the item already has, or 0. Surviving leaves are scored
exactly, and a rank-limited window keeps each item's ten best.

Spark plan: one pass over the texts keeps the words that are item terms (the stated query set,
broadcast below ``BROADCAST_TERMS``) and one length row per document, and counts them by
(doc_id, term) with map-side combining; only those counts are shuffled and written. Leaves are
hash-balanced (``LEAF`` documents, ``FANOUT`` leaves a bucket). N and L come from the length rows;
only doc_ids that occur in several rows are pooled by a grouping of their own.
Node maxima are aggregates with map-side combine. Bounds are joins on term between the block
maxima of the items (the stated query set) and the node maxima. Exact scores come from a co-group of
postings and asking items by leaf: one group holds one leaf's documents and gives back each item's
best of them. A hot term or a hot heaviest term is spread over leaves by the document hash.

Defined results:
- A null or empty text has no terms; such a document counts in neither N nor L and never scores.
- Rows sharing a doc_id are one document: their terms are pooled. Items are keyed by item_id in the
  same way. Items without terms, or whose terms occur in no document, return no rows.
- Equal scores rank by ascending doc_id; ranks are unique and start at 1. Only scores above 0 count.
- Extra columns of the inputs are never read, so names cannot clash. An empty table gives no rows.
- Very long texts are exploded into postings like any other; no term or text is cut.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.session import cut_lineage, release

#: fixed: a term is a maximal run outside ASCII controls, space, punctuation and symbols; only A-Z lower-cased
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
LEAF = 256
FANOUT = 16
ITEM_BLOCK = 8
SEED_LEAVES = 2
#: distinct item terms up to which the asked vocabulary is broadcast (about 100 bytes each)
BROADCAST_TERMS = 1_000_000
#: item blocks that meet a leaf in one group
PART_BLOCKS = 512
#: items and terms of one matrix product inside a leaf
ITEM_SLICE = 512
TERM_SLICE = 1024
BEST = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def _counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, F.explode(terms(F.col("text"))).alias("term")).groupBy(key, "term").agg(
        F.count(F.lit(1)).alias("tf"))


def _top(ranked: DataFrame, by: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """Rows ranked within ``by``; only the first ``k`` kept (Spark limits each group before its shuffle)."""
    window = Window.partitionBy(*by).orderBy(*order)
    return ranked.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def _slices(n: int, size: int) -> list[slice]:
    return [slice(i, i + size) for i in range(0, n, size)]


def _leaf_best(found: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """(item_id, doc_id, score) of the ``k`` best documents of one leaf for each item that asks for it.

    Documents and items meet in integer matrix products over the terms they share, in slices of
    bounded size: in doubles while every sum stays below 2**53 and so is exact, else in 64-bit integers.
    """
    sizes = asked["terms"].combine_chunks().value_lengths().to_numpy()
    ask_term = asked["terms"].combine_chunks().flatten().to_numpy()
    ask_q = asked["qs"].combine_chunks().flatten().to_numpy()
    ask_item = np.repeat(np.arange(len(sizes)), sizes)
    known = found["doc_id"].is_valid().to_numpy()
    doc = found["doc_id"].fill_null(0).to_numpy()
    term, c = found["term"].to_numpy(), found["c"].to_numpy()
    # documents numbered in the order that settles ties: null first, then ascending
    order = np.lexsort((doc, known))
    doc, known, term, c = doc[order], known[order], term[order], c[order]
    first = np.r_[True, (doc[1:] != doc[:-1]) | (known[1:] != known[:-1])]
    at = np.cumsum(first) - 1
    names = pa.array(doc[first], mask=~known[first])
    shared = np.intersect1d(term, ask_term)
    here, there = np.isin(term, shared), np.isin(ask_term, shared)
    at, c, term = at[here], c[here], np.searchsorted(shared, term[here])
    ask_item, ask_q, ask_term = ask_item[there], ask_q[there], np.searchsorted(shared, ask_term[there])
    totals = np.bincount(ask_item, ask_q, len(sizes))
    exact = not len(c) or totals.max() * float(c.max()) < 2.0**52
    kind = np.float64 if exact else np.int64
    made = []
    for items in _slices(len(sizes), ITEM_SLICE):
        width = min(items.stop, len(sizes)) - items.start
        scores = np.zeros((width, len(names)), kind)
        for terms_ in _slices(len(shared), TERM_SLICE):
            q = np.zeros((width, TERM_SLICE), kind)
            mine = (ask_item >= items.start) & (ask_item < items.stop) & (ask_term >= terms_.start) & (ask_term < terms_.stop)
            q[ask_item[mine] - items.start, ask_term[mine] - terms_.start] = ask_q[mine]
            held = np.zeros((TERM_SLICE, len(names)), kind)
            mine = (term >= terms_.start) & (term < terms_.stop)
            held[term[mine] - terms_.start, at[mine]] = c[mine]
            scores += q @ held
        scores = scores.astype("int64")
        best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(scores, best, axis=1)
        row, col = np.nonzero(value > 0)
        made.append(pa.table({
            "item_id": asked["item_id"].take(pa.array(items.start + row)),
            "doc_id": names.take(pa.array(best[row, col])), "score": pa.array(value[row, col])}))
    return pa.concat_tables(made).cast(BEST)


def _leaf_scores(item_terms: DataFrame, pairs: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """Exact (item_id, doc_id, score) of the pairs' items in their leaves: the ``k`` best of each leaf.

    ``pairs`` names (item_id, bucket, leaf). Postings and asking items are dealt by leaf and meet there
    as arrays, so no (item, term, leaf) or (item, document) row is shuffled. At most about
    ``PART_BLOCKS`` item blocks meet a leaf in one group.
    """
    blocks = item_terms.agg(F.max("iblock")).first()[0] or 0
    parts = blocks // PART_BLOCKS + 1
    entry = F.struct("term", "q")
    listed = item_terms.groupBy("item_id", "iblock").agg(F.collect_list(entry).alias("e")).select(
        "item_id", F.floor(F.col("iblock") / PART_BLOCKS).cast("int").alias("part"),
        F.col("e.term").alias("terms"), F.col("e.q").alias("qs"))
    asked = pairs.join(listed, "item_id").select("bucket", "leaf", "part", "item_id", "terms", "qs")
    leaves = pairs.select("bucket", "leaf").distinct()
    held = postings.join(leaves, ["bucket", "leaf"], "left_semi")
    held = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if parts > 1 else F.lit(0))
    keys = ["bucket", "leaf", "part"]

    def best(found: pa.Table, asking: pa.Table) -> pa.Table:
        return _leaf_best(found, asking, k) if len(found) and len(asking) else BEST.empty_table()

    return held.select(*keys, "doc_id", "term", "c").groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        best, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", report: dict | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``k`` best documents.

    Given a dict as ``report``, it receives the numbers of (block, leaf) pairs in all and scored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asks = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    item_words = cut_lineage(_counts(asks, "item_id"))
    # terms are numbered once; all later steps carry the number instead of the word
    vocabulary = cut_lineage(item_words.select(F.col("term").alias("word")).distinct().withColumn(
        "term", F.monotonically_increasing_id()))
    item_counts = cut_lineage(item_words.withColumnRenamed("term", "word").join(vocabulary, "word").select(
        "item_id", "term", "tf"))
    n_vocabulary = vocabulary.count()
    numbers = vocabulary
    if n_vocabulary <= BROADCAST_TERMS:
        numbers = F.broadcast(numbers)
    n_rows = texts.count()
    n_leaves = max(1, math.ceil(n_rows / LEAF))
    # one pass over the texts: postings of the asked terms, and one length row per document
    tokens = texts.select("doc_id", terms(F.col("text")).alias("t")).select(
        "doc_id", F.size("t").alias("n"), F.explode(F.concat("t", F.array(F.lit(None).cast("string")))).alias("word"))
    kept = tokens.join(numbers, "word", "left").where(F.col("term").isNotNull() | F.col("word").isNull())
    leaf = F.pmod(F.xxhash64("doc_id"), F.lit(n_leaves)).cast("int")
    index = cut_lineage(kept.groupBy("doc_id", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.max("n").alias("n"), F.sum("n").alias("pooled")).select(
        "doc_id", F.floor(leaf / F.lit(FANOUT)).cast("int").alias("bucket"), F.pmod(leaf, F.lit(FANOUT)).cast("int").alias("leaf"),
        "term", "tf", "n", "pooled"))
    # rows sharing a doc_id are one document: the length row sums their lengths and counts them
    lengths = index.where(F.col("term").isNull() & (F.col("pooled") > 0)).select(
        "doc_id", F.col("pooled").alias("n"), F.col("tf").alias("rows"))
    totals = lengths.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_terms = int(totals["N"] or 0), int(totals["L"] or 0)
    if n_docs == 0 or n_vocabulary == 0:
        release(item_words, vocabulary, item_counts, index)
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    norm = F.lit(100 - 75) + F.expr(f"(75 * n * {n_docs}L) div {n_terms}L")
    coordinate = F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")
    asked = index.where(F.col("term").isNotNull()).select("bucket", "leaf", "term", "doc_id", "tf", "n")
    repeated = lengths.where(F.col("rows") > 1).select("doc_id", "n")
    n_repeated = repeated.count()
    if n_repeated:
        repeated = F.broadcast(repeated) if n_repeated <= BROADCAST_TERMS else repeated
        asked = asked.join(repeated.select("doc_id"), "doc_id", "left_anti").unionByName(
            asked.drop("n").join(repeated, "doc_id").select("bucket", "leaf", "term", "doc_id", "tf", "n"))
    postings = asked.withColumn("m", norm).select("bucket", "leaf", "term", "doc_id", coordinate.alias("c"))
    weights = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (F.lit(2) * F.col("df") + 1).cast("double")))
        .cast("long").alias("w"))
    leaf_max = cut_lineage(postings.groupBy("bucket", "leaf", "term").agg(F.max("c").alias("cmax")))
    bucket_max = leaf_max.groupBy("bucket", "term").agg(F.max("cmax").alias("cmax"))
    # items: coordinates and blocks
    n_items = asks.select("item_id").distinct().count()
    n_blocks = max(1, math.ceil(n_items / ITEM_BLOCK))
    item_terms = cut_lineage(item_counts.join(weights, "term").select(
        "item_id", "term", (F.col("tf") * F.col("w")).alias("q"),
        F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int").alias("iblock")))
    block_max = item_terms.groupBy("iblock", "term").agg(F.max("q").alias("qmax"))

    def bounds(node_max: DataFrame, keys: list[str]) -> DataFrame:
        return block_max.join(node_max, "term").groupBy("iblock", *keys).agg(
            F.sum(F.col("qmax") * F.col("cmax")).alias("bound"))

    # seeds: exact scores in each block's best-bounded leaves of its best-bounded bucket
    bucket_bounds = cut_lineage(bounds(bucket_max, ["bucket"]))
    first = _top(bucket_bounds, ["iblock"], [F.desc("bound"), "bucket"], 1).select("iblock", "bucket")
    seed_leaves = _top(bounds(leaf_max.join(F.broadcast(first.select("bucket").distinct()), "bucket"), ["bucket", "leaf"])
                       .join(first, ["iblock", "bucket"]), ["iblock"], [F.desc("bound"), "leaf"], SEED_LEAVES)
    seed_leaves = cut_lineage(item_terms.select("item_id", "iblock").distinct().join(seed_leaves, "iblock").select(
        "item_id", "bucket", "leaf"))
    seeded = _top(_leaf_scores(item_terms, seed_leaves, postings, k), ["item_id"], [F.desc("score"), "doc_id"], k)
    kth = seeded.groupBy("item_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(1)).alias("t"))
    thresholds = cut_lineage(item_terms.select("item_id", "iblock").distinct().join(kth, "item_id", "left").select(
        "item_id", "iblock", F.coalesce("t", F.lit(1)).alias("threshold")))
    blocks = thresholds.groupBy("iblock").agg(F.min("threshold").alias("threshold"))
    # prune (item block, bucket) pairs below the block's weakest k-th score, then (item, leaf) pairs below the item's
    live_buckets = bucket_bounds.join(blocks, "iblock").where(F.col("bound") >= F.col("threshold")).select(
        "iblock", "bucket")
    leaf_pairs = item_terms.join(live_buckets, "iblock").join(leaf_max, ["bucket", "term"]).groupBy(
        "item_id", "bucket", "leaf").agg(F.sum(F.col("q") * F.col("cmax")).alias("bound"))
    live_leaves = cut_lineage(leaf_pairs.join(thresholds.select("item_id", "threshold"), "item_id").where(
        F.col("bound") >= F.col("threshold")).select("item_id", "bucket", "leaf"))
    if report is not None:
        report["leaf_pairs"] = n_items * leaf_max.select("bucket", "leaf").distinct().count()
        report["scored_leaf_pairs"] = live_leaves.count()
    best = _top(_leaf_scores(item_terms, live_leaves, postings, k), ["item_id"], [F.desc("score"), "doc_id"], k)
    result = cut_lineage(best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id",
                                     F.col("score").cast("long").alias("score")))
    release(item_words, vocabulary, item_counts, index, seed_leaves, leaf_max, item_terms, bucket_bounds, thresholds, live_leaves)
    return result
