import math

import numpy as np

from orebed.llm import capfilters

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, cid long"


def brute(rows, least):
    sound = lambda v, lab: lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [np.float64(np.float32(v)) / np.linalg.norm(np.float64(np.float32(v))) if sound(v, lab) else None for _, v, lab in rows]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] >= least:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(rows[i][0])
    low = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return sorted(((r[0], links[i], low[root(i)]) for i, r in enumerate(rows)), key=str)


def found(spark, rows, least=0.98):
    table = spark.createDataFrame([(*r, 9, 9) for r in rows], SCHEMA)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in capfilters.near_vectors(table, least).collect()), key=str)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        for dim in (2, 5, 16, 64):
            base = rng.standard_normal((30, dim))
            for v in base:
                for _ in range(rng.integers(1, 6)):
                    rows.append(v + rng.standard_normal(dim) * 0.12 * np.linalg.norm(v) / math.sqrt(dim))
                rows.append(v)
                rows.append(v * 3)
            rows = [(r if isinstance(r, tuple) else (0, [float(x) for x in r], label)) for r in rows]
    hot = rng.standard_normal(64)
    rows += [(0, [float(x) for x in hot + rng.standard_normal(64) * 0.08], 1) for _ in range(150)] + [(0, [float(x) for x in hot], 1)] * 100
    odd = [None, [], [0.0] * 8, [1.0, None], [1.0, float("nan")], [float("inf"), 1.0], [1e-30] * 4, [1e30] * 4, [-0.0, 1.0], [0.0, 1.0]]
    rows += [(0, v, 1) for v in odd] + [(0, [1.0, 0.0], None)] * 3
    order = rng.permutation(len(rows))
    rows = [(int(k), rows[i][1], rows[i][2]) for k, i in enumerate(order)]
    rows += [(None, rows[5][1], rows[5][2]), rows[6]]
    assert found(spark, rows) == brute(rows, 0.98)


def test_blocks_of_crowded_filters(spark, monkeypatch):
    monkeypatch.setattr(capfilters, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    hot = rng.standard_normal(12)
    rows = [(i, [float(x) for x in hot + rng.standard_normal(12) * 0.15], 1) for i in range(120)]
    assert found(spark, rows) == brute(rows, 0.98)


def test_recall_of_filters_alone():
    rng = np.random.default_rng(5)
    for dim, rows in ((3, 100), (16, 5000), (64, 200_000), (768, 50_000)):
        plan = capfilters.cap_plan(dim, rows)
        x = capfilters.unit_rows(rng.standard_normal((200, dim)))
        side = rng.standard_normal((200, dim))
        side = capfilters.unit_rows(side - (side * x).sum(1, keepdims=True) * x)
        y = 0.98 * x + math.sqrt(1 - 0.98**2) * side
        a, b = capfilters.decode(x, plan), capfilters.decode(y, plan)
        # these pairs lie at the threshold itself, where sharing a filter is least likely
        assert sum(bool(set(p) & set(q)) for p, q in zip(a, b, strict=True)) >= 198, dim


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert capfilters.near_vectors(table).count() == 0
