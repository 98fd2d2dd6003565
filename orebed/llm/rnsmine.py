"""Hard negatives for contrastive training, scored exactly through residues of small primes.

Method (residue-number-system GEMM): every component ``x`` becomes the integer ``floor(256 * x)``.
Scores of a block of anchors against a chunk of rows are integer inner products. They are computed
as float32 matrix products of the components' residues modulo several primes below 512. Residues
are centred (|r| <= 254), so a product sum over up to 260 components stays below 2**24, which
float32 holds exactly. Sums are reduced modulo the prime chunk by chunk. Garner's form of the
Chinese remainder theorem then rebuilds each signed score from its residues. Enough primes are used
that their product exceeds twice the largest score the block can reach. Selection is windowed:
an anchor's positives are its best same-label rows. For each positive, the negatives are the best
different-label rows whose score lies in ``[low, high]`` percent of the positive's score.

Spark plan: the valid rows are written once to the shared folder. Anchors are hashed into blocks of
about ``ANCHOR_BLOCK`` and rows into chunks of about ``ROW_CHUNK``. Every row is copied once per
anchor block and every anchor once per row chunk. A group ``(anchor block, row chunk)`` therefore
holds at most a bounded number of rows, whatever the table or label sizes; this is the stated
query set against all rows, in blocks. Each group keeps only its local best candidates per anchor
(positives) or per (anchor, positive) (negatives). A row-number window with a rank limit merges
them; Spark limits each group before its shuffle. Two passes run, because the negatives' window
needs the positives' final scores.

Defined results:
- Rows with a null id, label or vector, a null or non-finite component, or a component of
  magnitude 4096 or more (its score could leave 64 bits) take no part.
- Vectors of unequal length are compared over their common leading components. An empty vector
  scores 0 with everyone.
- Equal scores are ordered by the smaller id. A row never pairs with itself (equal id). Repeated
  rows with another id are ordinary rows.
- Anchors with fewer same-label rows than ``positives`` keep all they have. Positives with fewer
  window rows than ``negatives`` keep all they have. Anchors or positives without any produce no rows.
- Empty input gives an empty result. Columns other than id, label and vector are ignored, so
  clashing names do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.session import cut_lineage, release

SCALE = 256
#: magnitude bound of a component; beyond it a score could leave 64 bits
LIMIT = 4096.0
ANCHOR_BLOCK = 512
ROW_CHUNK = 4096
#: float32 represents every integer of smaller magnitude exactly
EXACT_FLOAT = 1 << 24


def _primes_below(limit: int) -> list[int]:
    sieve = np.ones(limit, bool)
    sieve[:2] = False
    for i in range(2, int(limit**0.5) + 1):
        if sieve[i]:
            sieve[i * i :: i] = False
    return [int(p) for p in np.nonzero(sieve)[0][::-1]]


def _moduli() -> tuple[int, ...]:
    """Largest primes below 512, as many as keep their product below 2**62."""
    out, product = [], 1
    for p in _primes_below(512):
        if product * p >= 1 << 62:
            break
        out.append(p)
        product *= p
    return tuple(out)


MODULI = _moduli()


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``(a @ b.T) mod p`` for integer matrices, through float32 products that stay exact."""
    half = p // 2
    ra = np.mod(a, p)
    rb = np.mod(b, p)
    ra = np.where(ra > half, ra - p, ra).astype(np.float32)
    rb = np.where(rb > half, rb - p, rb).astype(np.float32)
    step = max(1, (EXACT_FLOAT - 1) // max(1, half * half))
    out = np.zeros((a.shape[0], b.shape[0]), np.int64)
    for s in range(0, a.shape[1], step):
        part = ra[:, s : s + step] @ rb[:, s : s + step].T
        out = np.mod(out + part.astype(np.int64), p)
    return out


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact signed ``a @ b.T`` of int64 matrices from residues and Garner's reconstruction."""
    a = np.asarray(a, np.int64)
    b = np.asarray(b, np.int64)
    if a.shape[1] == 0 or a.size == 0 or b.size == 0:
        return np.zeros((a.shape[0], b.shape[0]), np.int64)
    bound = a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max())
    moduli, product = [], 1
    for p in MODULI:
        moduli.append(p)
        product *= p
        if product > 2 * bound:
            break
    if product <= 2 * bound:
        raise ValueError(f"scores up to {bound} exceed the exact range")
    digits = []
    for j, p in enumerate(moduli):
        r = residue_product(a, b, p)
        acc, radix = np.zeros_like(r), 1
        for i in range(j):
            acc = np.mod(acc + digits[i] * (radix % p), p)
            radix *= moduli[i]
        digits.append(np.mod((r - acc) * pow(radix % p, -1, p), p))
    value, radix = np.zeros_like(digits[0]), 1
    for p, d in zip(moduli, digits):
        value = value + d * radix
        radix *= p
    return np.where(value > product // 2, value - product, value)


def valid_rows(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, label, ints, *keep) of the rows that take part; see the module's defined results."""
    fits = F.forall(
        F.col(vec_col),
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(LIMIT)))
    return rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & fits).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("int")).alias("ints"),
        *keep)


def _matrix(cells: pd.Series) -> np.ndarray:
    """Rows padded with zeros to the longest: each pair's product runs over its common components."""
    arrays = [np.asarray(c, np.int64) for c in cells]
    out = np.zeros((len(arrays), max((len(x) for x in arrays), default=0)), np.int64)
    for i, x in enumerate(arrays):
        out[i, : len(x)] = x
    return out


def _block_scores(group: pd.DataFrame):
    """Anchors, rows (sorted by id) and their exact scores, or None if either side is empty."""
    anchors = group[group["role"] == 0]
    rows = group[group["role"] == 1].sort_values("id", kind="stable")
    if anchors.empty or rows.empty:
        return None
    a, r = _matrix(anchors["ints"]), _matrix(rows["ints"])
    width = min(a.shape[1], r.shape[1])
    return anchors, rows, exact_scores(a[:, :width], r[:, :width])


def _ranked(scores: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Per anchor, candidate columns by score descending and id ascending (columns are in id order)."""
    floor = np.iinfo(np.int64).min + 1
    return np.argsort(-np.where(allowed, scores, floor), axis=1, kind="stable")


POSITIVE_SCHEMA = "anchor_id long, positive_id long, positive_score long"
NEGATIVE_SCHEMA = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _local_positives(k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = _block_scores(group)
        if found is None:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("anchor_id", "positive_id", "positive_score")})
        anchors, rows, scores = found
        aid, rid = anchors["id"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        allowed = (anchors["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]) & (aid[:, None] != rid[None, :])
        order = _ranked(scores, allowed)[:, :k]
        take = np.take_along_axis(allowed, order, axis=1)
        i, j = np.nonzero(take)
        cols = order[i, j]
        return pd.DataFrame({"anchor_id": aid[i], "positive_id": rid[cols], "positive_score": scores[i, cols]})

    return run


def _local_negatives(k: int, low: int, high: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = _block_scores(group)
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        if found is None:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
        anchors, rows, scores = found
        rid = rows["id"].to_numpy(np.int64)
        other = anchors["label"].to_numpy()[:, None] != rows["label"].to_numpy()[None, :]
        order = _ranked(scores, other)
        out = {c: [] for c in names}
        for n, (aid, pids, pscores) in enumerate(zip(anchors["id"], anchors["pos_ids"], anchors["pos_scores"])):
            ranked = order[n]
            ranked = ranked[other[n, ranked]]
            s = scores[n, ranked]
            for pid, ps in zip(pids, pscores):
                hit = ranked[(low * ps <= 100 * s) & (100 * s <= high * ps)][:k]
                out["anchor_id"].extend([aid] * len(hit))
                out["positive_id"].extend([pid] * len(hit))
                out["positive_score"].extend([ps] * len(hit))
                out["negative_id"].extend(rid[hit].tolist())
                out["negative_score"].extend(scores[n, hit].tolist())
        return pd.DataFrame({c: np.asarray(v, np.int64) for c, v in out.items()})

    return run


def _blocks(valid: DataFrame) -> tuple[DataFrame, int, int]:
    """Valid rows with their anchor block and row chunk, written once, and the numbers of both."""
    counts = valid.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("a")).first()
    n_blocks = max(1, math.ceil((counts["a"] or 0) / ANCHOR_BLOCK))
    n_chunks = max(1, math.ceil((counts["n"] or 0) / ROW_CHUNK))
    spread = F.xxhash64("id")
    written = cut_lineage(valid.withColumn("ablock", F.pmod(spread, F.lit(n_blocks)).cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64(spread), F.lit(n_chunks)).cast("int")))
    return written, n_blocks, n_chunks


def _pairs(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_chunks: int) -> DataFrame:
    """Each row once per anchor block, each anchor once per row chunk, keyed by (ablock, chunk)."""
    row_side = rows.select(
        F.lit(1).alias("role"), "id", "label", "ints",
        F.lit(None).cast("array<long>").alias("pos_ids"), F.lit(None).cast("array<long>").alias("pos_scores"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("ablock"), "chunk")
    anchor_side = anchors.select(
        F.lit(0).alias("role"), "id", "label", "ints", "pos_ids", "pos_scores", "ablock",
        F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"))
    return row_side.unionByName(anchor_side)


def hard_negatives(rows: DataFrame, anchor: Column, *, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    ``anchor`` is a boolean column of ``rows`` naming the anchors; see the module for the rules.
    """
    prepared = rows.select(F.col(id_col).alias("_i"), F.col(vec_col).alias("_v"), F.col(label_col).alias("_l"),
                           F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    written, n_blocks, n_chunks = _blocks(valid_rows(prepared, "_i", "_v", "_l", keep=("is_anchor",)))
    no_pos = F.lit(None).cast("array<long>")
    anchors = written.where("is_anchor").withColumn("pos_ids", no_pos).withColumn("pos_scores", no_pos)
    local = _pairs(written, anchors, n_blocks, n_chunks).groupBy("ablock", "chunk").applyInPandas(
        _local_positives(positives), POSITIVE_SCHEMA)
    by_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = local.withColumn("r", F.row_number().over(by_anchor)).where(F.col("r") <= positives).drop("r")
    best = cut_lineage(best)
    carried = best.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("p"))
    anchors = written.where("is_anchor").join(carried.withColumnRenamed("anchor_id", "id"), "id").select(
        "id", "label", "ints", "ablock", "chunk",
        F.col("p.positive_id").alias("pos_ids"), F.col("p.positive_score").alias("pos_scores"))
    local = _pairs(written, anchors, n_blocks, n_chunks).groupBy("ablock", "chunk").applyInPandas(
        _local_negatives(negatives, low, high), NEGATIVE_SCHEMA)
    by_pair = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = local.withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= negatives)
    result = cut_lineage(found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score"))
    release(written, best)
    return result
