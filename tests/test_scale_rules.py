"""Operators read all rows, split hot groups and give one meaning on both sides of their plan switches."""

import math

import pytest
from pyspark.sql import functions as F

from orebed.functions import orderstats as O
from orebed.operators import anomaly as A
from orebed.operators import clustering as K
from orebed.operators import correlation as R
from orebed.operators import sampling as W
from orebed.operators import selection as S
from orebed.operators.components import connected_components
from orebed.session import cut_lineage, release


def test_correlation_of_columns_that_do_not_vary(spark, monkeypatch):
    rows = [(float(i), float(i * i % 7), 5.0, 3.1 if i % 2 else None, float("nan") if i == 4 else float(-i)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, constant double, inner double, holes double")
    df = df.withColumn("only_even", F.when(F.col("inner").isNull(), F.col("a")).otherwise(1.0))
    cols = df.columns
    found = {}
    for limit in (200, 0):
        monkeypatch.setattr(R, "EXPRESSION_PAIRS", limit)
        found[limit] = {(a, b): r for a, b, r in R.pair_correlations(df, cols)}
        assert len(found[limit]) == len(cols) * (len(cols) - 1) // 2
    for pair, r in found[200].items():
        other = found[0][pair]
        assert (r is None) == (other is None) and (r is None or math.isclose(r, other, abs_tol=1e-9))
        if "constant" in pair or "inner" in pair:
            assert r is None
    assert found[200]["inner", "only_even"] is None
    assert math.isclose(found[200]["a", "holes"], -1.0)
    assert S.prune_correlated(df, cols, 0.9)[1] == ["holes"]


@pytest.mark.parametrize("n", [3, 2000])
def test_samples_of_hot_groups(spark, n):
    df = spark.range(9000).selectExpr("id AS row_id", "IF(id % 3 < 2, 'hot', IF(id % 50 = 2, NULL, concat('g', id % 5))) AS g")
    got = {r["g"]: r["n"] for r in W.stratified_sample(df, "g", n, 7).groupBy("g").agg(F.count("*").alias("n")).collect()}
    size = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert got == {g: min(n, m) for g, m in size.items()}
    one = sorted(r["row_id"] for r in W.stratified_sample(df, "g", n, 7).collect())
    assert one == sorted(r["row_id"] for r in W.stratified_sample(df.repartition(13), "g", n, 7).collect())
    top = W.top_k_per_group(df, "g", [F.desc("row_id")], n).collect()
    want = {}
    for r in sorted(df.collect(), key=lambda r: -r["row_id"]):
        want.setdefault(r["g"], []).append(r["row_id"])
    assert {(r["g"], r["rank"], r["row_id"]) for r in top} == {(g, k, i) for g, v in want.items() for k, i in enumerate(v[:n], 1)}


def test_trees_draw_from_all_rows(spark):
    df = spark.range(70_000).selectExpr("id AS row_id", "double(id) AS x", "double(id % 97) AS y")
    nodes = A.isolation_trees(df, ["x"], trees=30, psi=64)
    cuts = [r["cut"] for r in nodes.where("feature >= 0").collect()]
    assert nodes.agg(F.min("rows")).first()[0] == 64
    assert min(cuts) < 3000 and max(cuts) > 67_000
    few = A.isolation_trees(df.limit(10), ["x"], trees=5, psi=64)
    assert {r["rows"] for r in few.collect()} == {10}
    holes = df.limit(50).withColumn("x", F.when(F.col("row_id") % 5 > 0, F.col("x")))
    scored = A.isolation_scores(holes, ["x", "y"], trees=5, psi=16)
    assert scored.count() == 50 and scored.where("if_score is null").count() == 10


def test_cutoffs_skip_null_scores(spark):
    df = spark.range(100).selectExpr("id AS row_id", "IF(id < 60, double(id), NULL) AS s", "false AS f")
    masks = A.score_cutoffs(df, "s", "f", share=0.05)
    assert df.where(masks["top_0.05"]).count() == 3


def test_information_does_not_depend_on_the_unit(spark):
    df = spark.range(600).selectExpr("id AS row_id", "id % 3 AS y", "double((id * 7919) % 101 + 40 * (id % 3)) AS x")
    df = df.selectExpr("*", "x * 1e-9 AS small", "x * 1e12 + 5e12 AS large", "3.0D AS same")
    mi = {r["feature"]: r["mi"] for r in S.mutual_info_knn(df, ["x", "small", "large", "same"], "y").collect()}
    assert mi["x"] > 0.1 and math.isclose(mi["x"], mi["small"], rel_tol=1e-9) and math.isclose(mi["x"], mi["large"], rel_tol=1e-9)


def test_silhouette_in_blocks(spark, monkeypatch):
    df = spark.range(90).selectExpr("id AS row_id", "double(id % 2 * 10 + id % 7) AS x", "double(id % 5) AS y", "id % 2 AS label")
    whole = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(df, ["x", "y"], "label", None).collect()}
    monkeypatch.setattr(K, "SILHOUETTE_BLOCK", 11)
    for parts in (1, 16):
        cut = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(df.repartition(parts), ["x", "y"], "label", None).collect()}
        assert cut.keys() == whole.keys() and all(math.isclose(cut[k], whole[k], abs_tol=1e-12) for k in whole)
    lone = K.silhouette_samples(df.withColumn("label", F.lit(1)), ["x", "y"], "label", None)
    assert {r["silhouette"] for r in lone.collect()} == {0.0}


def test_tree_labels_and_small_agreement(spark):
    df = spark.range(200).selectExpr("id AS row_id", "double(id % 4 * 100 + id % 3) AS x")
    cut = K.hierarchical_bisect(df, ["x"], 4)
    assert cut.columns == ["row_id", "x", "segment"]
    assert sorted({(int(r["x"] // 100), r["segment"]) for r in cut.collect()}) == [(i, i) for i in range(4)]
    for n in (0, 1):
        assert K.adjusted_rand(df.limit(n), "x", "row_id").first()["ari"] == 1.0


def test_components_and_released_tables(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60) if i % 20] + [(100, 100)], "a long, b long")
    nodes = spark.range(101).selectExpr("id")
    got = {r["id"]: r["label"] for r in connected_components(nodes, edges).collect()}
    want = {i: i for i in range(101)}
    for a, b in sorted((r["a"], r["b"]) for r in edges.collect()):
        want[b] = want[a] if a != b else b
    assert got == want
    table = cut_lineage(nodes)
    path = table._cut_path
    release(table, None)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    assert not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _ross(xs, ys, k):
    """Brute-force nearest-neighbour mutual information over (value, class) points."""
    from collections import Counter

    pts = [(x, y) for x, y in zip(xs, ys) if x is not None and y is not None]
    n_y = Counter(y for _, y in pts)
    pts = [(x, y) for x, y in pts if n_y[y] > 1]
    if not pts:
        return None
    psi = lambda v: digamma_exact(v)
    total = 0.0
    for i, (x, y) in enumerate(pts):
        kk = min(k, n_y[y] - 1)
        d = sorted(abs(x - x2) for j, (x2, y2) in enumerate(pts) if j != i and y2 == y)[kk - 1]
        m = sum(1 for x2, _ in pts if (abs(x2 - x) < d if d > 0 else x2 == x))
        total += psi(kk) - psi(n_y[y]) - psi(m)
    return max(0.0, psi(len(pts)) + total / len(pts))


def digamma_exact(v):
    x, out = float(v), 0.0
    while x < 8:
        out -= 1 / x
        x += 1
    inv2 = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 / 240)))


def test_information_in_slices_equals_brute_force(spark):
    import random

    rng = random.Random(7)
    rows = []
    for i in range(700):
        y = rng.choice("abc") if i % 50 else None
        x = None if i % 37 == 0 else (7.0 if i % 3 == 0 else float(rng.randrange(60) + 15 * "abc".index(y or "a")))
        rows.append((i, y, x, float(i % 2)))
    rows.append((900, "lone", 3.0, 1.0))
    df = spark.createDataFrame(rows, "row_id long, y string, x double, z double")
    want = {f: _ross([r[2 if f == "x" else 3] for r in rows], [r[1] for r in rows], 5) for f in ("x", "z")}
    for slices in (1, 3, 16):
        got = {r["feature"]: r["mi"] for r in S.mutual_info_knn(df, ["x", "z"], "y", slices=slices).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[f], want[f], rel_tol=1e-9, abs_tol=1e-12) for f in want), (slices, got, want)


def _lloyd(points, start, iters=100):
    import numpy as np

    c = np.array(start, float)
    for _ in range(iters):
        d2 = ((points[:, None, :] - c[None, :, :]) ** 2).sum(-1)
        near = d2.argmin(1)
        fresh = np.array([points[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        if np.allclose(fresh, c, rtol=0, atol=1e-12):
            break
        c = fresh
    return sorted(map(tuple, c))


def test_kmeans_runs_share_passes_and_ignore_partitions(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    pts = np.concatenate([rng.normal(m, 0.3, (60, 2)) for m in ((0, 0), (4, 1), (1, 5))])
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(pts)] + [(500, None, 1.0)]
    df = spark.createDataFrame(rows, "row_id long, x double, y double")
    runs = [(k, s) for k in (2, 3, 4) for s in (0, 1)]
    whole = K.kmeans_runs(df, ["x", "y"], runs, max_iter=100, tol=0.0)
    split = K.kmeans_runs(df.repartition(16), ["x", "y"], runs, max_iter=100, tol=0.0)
    for (k, s), a, b in zip(runs, whole, split):
        assert len(a.points) == k and np.allclose(a.points, b.points, atol=1e-9) and math.isclose(a.cost, b.cost, rel_tol=1e-9)
        starts = sorted(df.where("x IS NOT NULL").selectExpr("xxhash64(row_id, %d) AS h" % s, "row_id", "x", "y")
                        .orderBy("h", "row_id").limit(k).select("x", "y").collect())
        assert np.allclose(a.points, _lloyd(pts, [tuple(r) for r in starts]), atol=1e-9)
    best = K.kmeans_fit(df, ["x", "y"], 3, n_init=3, seed=0)
    assert math.isclose(best.cost, min(f.cost for f in K.kmeans_runs(df, ["x", "y"], [(3, 0), (3, 1), (3, 2)])), rel_tol=1e-12)


def test_correlations_compute_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    cols = [f"c{i}" for i in range(11)]
    df = spark.range(200).selectExpr(*[f"CAST((id * {2 * i + 3}) % 37 AS DOUBLE) AS {c}" for i, c in enumerate(cols)])
    found = R.pair_correlations(df.mapInPandas(count, df.schema), cols)
    assert seen.value == 200
    for a, b, r in found:
        assert math.isclose(r, df.stat.corr(a, b), abs_tol=1e-9)


def test_correlations_of_sides_far_from_the_mean(spark):
    """Centred sums cancel where the complete rows of a pair lie close together, far from the column's mean."""
    rows = [(1e6 + i * 1e-3, float(i * i % 11)) if i < 40 else (-float(i), None) for i in range(80)]
    df = spark.createDataFrame(rows, "a double, b double")
    expected = df.where("b is not null").stat.corr("a", "b")
    assert math.isclose(R.pair_correlations(df, ["a", "b"])[0][2], expected, abs_tol=1e-9)


def test_quantiles_share_one_sketch_per_column(spark, monkeypatch):
    """All ranks of a column start from the same bracket: a sketch each would read every value once per rank."""
    sketched = []
    plain = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, acc: sketched.append(len(p)) or plain(c, p, acc))
    df = spark.range(6000).selectExpr("CAST((id * 37) % 5987 AS DOUBLE) AS a", "CAST(IF(id % 7 = 0, NULL, id * id % 4999) AS DOUBLE) AS b")
    probs = [i / 10 for i in range(11)]
    found = O.exact_quantiles(df, ["a", "b"], probs, small_rows=10)
    assert len(sketched) == 2
    small = O.exact_quantiles(df, ["a", "b"], probs)
    for c in ("a", "b"):
        assert all(math.isclose(x, y) for x, y in zip(found[c], small[c]))


def test_silhouette_sends_rows_a_bounded_number_of_times(spark, monkeypatch):
    monkeypatch.setattr(K, "SILHOUETTE_BLOCK", 7)
    monkeypatch.setattr(K, "SILHOUETTE_GROUPS", 3)
    monkeypatch.setattr(K, "SILHOUETTE_TILE", 5)
    asked = []
    plain = K._distance_sums
    monkeypatch.setattr(K, "_distance_sums", lambda rows, names, key, groups: asked.append(groups) or plain(rows, names, key, groups))
    rows = [(i, float(i % 13), float(i * i % 17), i % 4) for i in range(90)]
    df = spark.createDataFrame(rows, "row_id long, x double, y double, g int")
    got = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(df, ["x", "y"], "g", None).collect()}
    assert asked == [3]
    assert K.silhouette_samples(df, ["x", "y"], "g", None).count() == 90
    for i, x, y, g in rows:
        mean = {}
        for k in range(4):
            d = [math.dist((x, y), (u, v)) for j, u, v, h in rows if h == k and j != i]
            mean[k] = sum(d) / len(d)
        a, b = mean[g], min(m for k, m in mean.items() if k != g)
        assert math.isclose(got[i], (b - a) / max(a, b), abs_tol=1e-12)


def test_group_cuts_are_broadcast(spark):
    df = spark.range(5000).selectExpr("id AS row_id", "IF(id % 9 < 8, 'hot', NULL) AS g", "id / 5000 AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = W._below_cuts(df, ["g"], 5, "v")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_isolation_trees_draw_in_one_pass(spark):
    """The drawn rows are read from a written table, not drawn again for the ranking."""
    df = spark.range(3000).selectExpr("id AS row_id", "CAST(id * 7 % 101 AS DOUBLE) AS a", "CAST(id * id % 97 AS DOUBLE) AS b")
    plan = A.isolation_trees(df, ["a", "b"], 5, 16)._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" not in plan and "Generate" not in plan


def test_walkable_tree_gives_the_paths_of_its_nodes():
    rng = A.np.random.default_rng(5)
    x = rng.normal(size=(64, 3))
    tree = A._grow(x, A.np.random.default_rng(1), 6)
    feature, cut, left, path, levels = A._walkable(tree)
    for row in list(x) + [A.np.array([float("inf")] * 3)]:
        node, at = 0, 0
        while tree["feature"][node] >= 0:
            node = tree["left"][node] + int(row[tree["feature"][node]] > tree["cut"][node])
        for _ in range(levels):
            at = left[at] + int(row[feature[at]] > cut[at])
        assert path[at] == tree["path"][node]


def test_neighbour_slices_travel_as_arrays(spark, monkeypatch):
    df = spark.range(4000).selectExpr(
        "id AS row_id", "IF(id % 2 = 0, IF(id % 4 = 0, 0.0D, -0.0D), 1.0D) AS y", "double(id * 37 % 4001) AS x", "double(id % 9) AS z")
    whole = {r["feature"]: r["mi"] for r in S.mutual_info_knn(df, ["x", "z"], "y", slices=1).collect()}
    written = []
    cut = S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda t: written.append(cut(t)) or written[-1])
    monkeypatch.setattr(S, "HELD_VALUES", 1)
    found = {r["feature"]: r["mi"] for r in S.mutual_info_knn(df.repartition(3), ["x", "z"], "y", slices=8).collect()}
    assert found.keys() == whole.keys() and all(math.isclose(found[f], whole[f], rel_tol=1e-9, abs_tol=1e-12) for f in whole)
    # 8,000 points: arrays of a slice, and the few points whose radius leaves it
    assert written and all(t.count() < 400 for t in written)


def test_plane_from_fitted_components(spark, monkeypatch):
    from orebed.operators import reduction as D

    df = spark.range(50).selectExpr("id AS row_id", "double(id) AS a", "double(id * id % 7) AS b", "double(id % 3) AS c")
    fit = D.pca_fit(df, ["a", "b", "c"])
    want = D.project_2d(df, ["a", "b", "c"]).collect()
    monkeypatch.setattr(D, "covariance", None)  # the fit is not made again
    assert D.project_2d(df, ["a", "b", "c"], fit=fit).collect() == want
