"""Trees of cells against brute force, over clusters of every extent, hot places, repeated keys and missing places."""

import math
import os
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import functions as F

from orebed.operators import clustering as K
from orebed.operators import density as D
from orebed.operators import distances as DS
from orebed.operators import neighbors as B
from orebed.operators import tiles as T
from orebed.session import shared_dir


def _silhouettes(rows):
    """Brute force over rows of label and place."""
    places = {k: np.array([r[1:] for r in rows if r[0] == k], float) for k in {r[0] for r in rows}}
    out = {}
    for i, (label, x, y) in enumerate(rows):
        total = {k: np.hypot(p[:, 0] - x, p[:, 1] - y).sum() for k, p in places.items()}
        a = total[label] / max(len(places[label]) - 1, 1)
        b = min(v / len(places[k]) for k, v in total.items() if k != label)
        out[i] = 0.0 if len(places[label]) == 1 else (b - a) / max(a, b)
    return out


def _plane_rows(n):
    """Clusters of very different extent, one far away, one inside another, one lone row, and a hot place."""
    rng = np.random.default_rng(n)
    rows = [(i % 3, *(np.array([[0, 0], [4, 1], [0.1, 0.1]][i % 3]) + rng.normal(size=2) * [1, 2, 0.01][i % 3])) for i in range(n)]
    rows += [(3, 1e5, -1e5 + i) for i in range(9)] + [(4, 0.5, 0.5)] + [(1, 2.0, -0.0)] * (n // 4)
    return [(k, float(x), float(y)) for k, x, y in rows]


def test_plane_silhouette_takes_no_pairs_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "DIRECT_ROWS", 0)
    monkeypatch.setattr(K, "DIRECT_SUMS", 0)
    monkeypatch.setattr(K, "_distance_sums", None)
    monkeypatch.setattr(DS, "LEAF_POINTS", 20)
    monkeypatch.setattr(T, "TASK_POINTS", 150)
    near = []
    plain = DS.meetings

    def counted(forest, clusters, limits):
        met = plain(forest, clusters, limits)
        near.append((forest.tasks, (forest.count[met["points_points"][0]] * forest.count[met["points_points"][1]]).sum()))
        return met

    monkeypatch.setattr(DS, "meetings", counted)
    for n in (300, 1200):
        rows = _plane_rows(n)
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, g int, x double, y double")
        got = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(df, ["x", "y"], "g", None).collect()}
        want = _silhouettes(rows)
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], abs_tol=1e-11) for i in want)
    assert near[1][0] > 5 and near[1][1] < 8 * near[0][1]
    lone = K.silhouette_samples(df.withColumn("g", F.lit("a")), ["x", "y"], "g", None)
    assert {r["silhouette"] for r in lone.collect()} == {0.0}


def test_plane_silhouette_keeps_repeated_keys_and_missing_places(spark, monkeypatch):
    rows = _plane_rows(90)
    keys = [i - i % 2 if i < 40 and rows[i][0] == rows[i - i % 2][0] else i for i in range(len(rows))]
    keys[4] = keys[7]
    table = [(k, *r) for k, r in zip(keys, rows)] + [(None, 0, 1.0, 1.0)]
    df = spark.createDataFrame(table, "row_id long, g int, x double, y double")
    plain = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(df, ["x", "y"], "g", None).collect()}
    missing = df.unionByName(df.limit(1).selectExpr("500L AS row_id", "3 AS g", "double(null) AS x", "1D AS y"))
    part = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(missing, ["x", "y"], "g", None).collect()}
    monkeypatch.setattr(K, "DIRECT_ROWS", 0)
    monkeypatch.setattr(K, "DIRECT_SUMS", 0)
    monkeypatch.setattr(K, "_distance_sums", None)
    for table, want in ((df, plain), (missing, part)):
        got = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(table, ["x", "y"], "g", None).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], abs_tol=1e-11) for i in want)


def test_distances_to_the_kth_row_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(T, "TASK_POINTS", 100)
    monkeypatch.setattr(B, "neighbor_table", None)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.uniform(size=(600, 2)), rng.normal(size=(400, 2)) * 1e-4 + 0.5, [[9e3, -5.0]] * 3, [[0.25, 0.75]] * 60])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "row_id long, x double, y double")
    ks = [1, 7, 50]
    got = {(r["x0"], r["x1"]): [r[f"kd_{k}"] for k in ks] for r in B.k_distance_points(df, ["x", "y"], ks).collect()}
    assert len(got) == 1002
    for place, found in got.items():
        want = np.sort(np.sqrt(((x - np.array(place)) ** 2).sum(axis=1)))[[k - 1 for k in ks]]
        assert found == want.tolist()


def test_sweep_keeps_no_tables_and_compares_no_pairs_of_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = np.concatenate([c + rng.normal(size=(60, 2)) * 0.2 for c in ([0, 0], [3, 0], [0, 4], [5, 5])])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "row_id long, x double, y double")
    plain = D.dbscan_sweep(df, ["x", "y"], (4, 8)).collect()
    monkeypatch.setattr(K, "DIRECT_ROWS", 0)
    monkeypatch.setattr(K, "DIRECT_SUMS", 0)
    monkeypatch.setattr(K, "_distance_sums", None)
    place = urlparse(shared_dir(spark)).path
    before = set(os.listdir(place))
    trees = D.dbscan_sweep(df, ["x", "y"], (4, 8)).collect()
    assert set(os.listdir(place)) == before
    assert [r[:4] for r in trees] == [r[:4] for r in plain] and plain[0]["regions"] >= 2
    for a, b in zip(trees, plain):
        assert math.isclose(a["silhouette"], b["silhouette"], abs_tol=1e-11)
