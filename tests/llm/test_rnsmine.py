"""Hard-negative mining: exact residue products, the operator against a brute-force miner, edge cases."""

import math
import random

import numpy as np
import pytest

from orebed.llm import rnsmine

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def brute(rows, anchor, positives=5, negatives=3, low=50, high=95):
    ok = []
    for vid, vec, label, *_ in rows:
        if vid is None or label is None or vec is None:
            continue
        if any(x is None or math.isnan(x) or not abs(x) < rnsmine.LIMIT for x in vec):
            continue
        ok.append((vid, [math.floor(256 * float(x)) for x in vec], label))
    out = []
    for aid, avec, alabel in ok:
        if not anchor(aid):
            continue
        scored = sorted(((-sum(p * q for p, q in zip(avec, v)), vid, lab) for vid, v, lab in ok if vid != aid))
        pos = [(vid, -s) for s, vid, lab in scored if lab == alabel][:positives]
        for pid, ps in pos:
            hits = [(vid, -s) for s, vid, lab in scored if lab != alabel and low * ps <= -100 * s <= high * ps][:negatives]
            out += [(aid, pid, r + 1, nid, ps, ns) for r, (nid, ns) in enumerate(hits)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_exact_scores_match_integer_products():
    rng = np.random.default_rng(3)
    for width, top in [(64, 160), (300, 4095 * 256), (1, 1), (700, 2000)]:
        a = rng.integers(-top, top + 1, (17, width))
        b = rng.integers(-top, top + 1, (29, width))
        assert np.array_equal(rnsmine.exact_scores(a, b), a @ b.T)
    assert rnsmine.exact_scores(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).shape == (2, 3)


def test_float32_alone_would_round():
    a = np.array([[4095 * 256 - 1, 3] * 32])
    assert not np.array_equal((a.astype(np.float32) @ a.T.astype(np.float32)).astype(np.int64), a @ a.T)
    assert np.array_equal(rnsmine.exact_scores(a, a), a @ a.T)


def _table(rng, n, labels=4, width=8):
    rows = []
    for i in range(n):
        vec = [round(rng.uniform(-0.6, 0.6), 3) for _ in range(width)]
        rows.append((i, vec, rng.randrange(labels), "x"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_operator_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(rnsmine, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(rnsmine, "ROW_CHUNK", 17)
    rng = random.Random(seed)
    rows = _table(rng, 120)
    rows += [(500, rows[3][1], rows[3][2], "copy"), (501, rows[3][1], 1 - rows[3][2] % 2, "copy")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = rnsmine.hard_negatives(df, df.vec_id % 5 == 0)
    assert got(found) == brute(rows, lambda i: i % 5 == 0)
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                  "positive_score": "bigint", "negative_score": "bigint"}


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [0.5, 0.5], 1, None), (1, [0.5, 0.4], 1, None), (2, [0.4, 0.4], 2, None), (3, [0.5, 0.4], 2, None),
        (4, None, 1, None), (5, [0.5, None], 1, None), (6, [nan, 0.1], 2, None), (7, [inf, 0.1], 2, None),
        (8, [0.5, 0.5], None, None), (9, [], 2, None), (10, [0.5], 2, None), (11, [0.45, 0.45], 2, None),
        (None, [0.5, 0.5], 1, None), (12, [5000.0, 1.0], 1, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("extra", "anchor_id")
    found = rnsmine.hard_negatives(df, df.vec_id % 2 == 0)
    assert got(found) == brute([r for r in rows if r[0] is not None], lambda i: i % 2 == 0)
    assert got(found)


def test_empty_and_ties(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rnsmine.hard_negatives(empty, empty.vec_id % 2 == 0).count() == 0
    rows = [(i, [0.25, 0.25], i % 2, None) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(rnsmine.hard_negatives(df, df.vec_id == 0, low=0, high=100)) == brute(
        rows, lambda i: i == 0, low=0, high=100)
