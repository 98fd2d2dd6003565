"""Hand-made edge cases of single operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.config import DOMAIN_BINS, EMPLOYMENT_YEARS, MISSING_OTHER, MISSING_RULES
from orebed.functions import orderstats as O
from orebed.functions.columns import digamma
from orebed.functions.stats import chi2_quantile
from orebed.operators import anomaly as A
from orebed.operators import clustering as K
from orebed.operators import columns as C
from orebed.operators import correlation as R
from orebed.operators import density as D
from orebed.operators import neighbors as B
from orebed.operators import nulls as N
from orebed.operators import profile as P
from orebed.operators import ranking as G
from orebed.operators import reduction
from orebed.operators import rules as U
from orebed.operators import sampling as W
from orebed.operators import selection as S
from orebed.operators.components import connected_components
from orebed.sources.readers import nan_to_null


def values(df, col, order="row_id"):
    return [r[0] for r in df.orderBy(order).select(col).collect()]


def column(spark, data, kind="double", name="v"):
    return spark.createDataFrame(list(enumerate(data)), f"row_id bigint, {name} {kind}")


def test_parsing(spark):
    df = column(spark, ["13.56%", " 5%", "", "n/a", None], "string")
    assert values(C.parse_percent(df, ["v"]), "v") == [13.56, 5.0, None, None, None]
    df = column(spark, [" 36 months", "60 months", "x", None], "string")
    assert values(C.parse_term(df, "v"), "v") == [36, 60, None, None]
    df = column(spark, ["< 1 year", "10+ years", "?", None], "string")
    assert values(C.map_values(df, "v", EMPLOYMENT_YEARS), "v") == [0, 10, None, None]
    many = {str(i): i for i in range(500)}
    assert values(C.map_values(column(spark, ["7", "499", "x"], "string"), "v", many), "v") == [7, 499, None]
    assert values(nan_to_null(column(spark, [1.0, float("nan"), None])), "v") == [1.0, None, None]


def test_bins(spark):
    edges, labels = DOMAIN_BINS["dti"]
    df = column(spark, [20.0, 35.0, 43.0, 43.1, None])
    got = values(C.cut_bin(df, "v", edges, ["a", "b", "c", "d"]), "v")
    assert got == ["a", "b", "c", "d", None] and len(labels) == 4
    df = column(spark, [1.0] * 6 + [2.0, 3.0, 4.0, 5.0])
    got = values(C.quantile_bin(df, {"v": ("w", "x", "y", "z")}), "v_bin")
    assert got[:6] == ["w"] * 6 and got[-1] == "x"  # repeated edges merge, later labels go unused


def test_column_dropping(spark):
    n = 100
    rows = [
        (i, 1, None if i else 5.0, None, None if i < 40 else 1.0 * i, None if i < 41 else 1.0 * i,
         None if i < 99 else "x", "a" if i < 99 else "b", "a" if i < 98 else "b") for i in range(n)
    ]
    df = spark.createDataFrame(rows, "row_id int, one int, single double, nothing double, m40 double, m41 double, nul string, s99 string, s98 string")
    assert set(df.columns) - set(C.drop_constant(df).columns) == {"one", "single", "nothing", "nul"}
    kept = C.drop_high_missing(df, 40.0).columns
    assert "m40" in kept and "m41" not in kept
    gone = set(df.columns) - set(C.drop_quasi_constant(df, 0.99, protect=["one"], keep=["row_id"]).columns)
    assert gone == {"single", "nothing", "nul", "s99"}
    assert C.find_column(df, "Kind", "m4") == "m40" and C.find_column(df, "one", "x") == "one"


def test_imputation(spark):
    assert values(N.impute_mode(column(spark, ["b", "a", "b", "a", None], "string"), ["v"]), "v")[-1] == "a"
    rows = [(1, "g", 1.0), (2, "g", 3.0), (3, "g", None), (4, "h", None), (5, None, None)]
    df = spark.createDataFrame(rows, "row_id int, g string, v double")
    assert values(N.impute_group_mean(df, "v", "g"), "v") == [1.0, 3.0, 2.0, 2.0, 2.0]
    df = spark.createDataFrame([(3, 1, None), (1, 1, None), (2, 1, "x")], "row_id int, a int, b string")
    assert sorted(values(N.dedup_rows(df), "row_id")) == [1, 2]
    assert N.count_nulls(df).first()[0] == 2
    names = spark.createDataFrame([("id",), ("sec_app_x",), ("mths_since_y",), ("open_il_24m",), ("zzz",)], "feature string")
    got = [r[0].split(" —")[0] for r in N.classify_missing(names, MISSING_RULES, MISSING_OTHER).select("mechanism").collect()]
    assert got == ["IDENTIFIER", "STRUCTURAL", "STRUCTURAL", "MAR TEMPORAL", "TO REVIEW"]


def test_order_statistics_of_large_columns(spark, monkeypatch):
    rng = np.random.default_rng(3)
    data = np.where(rng.random(6000) < 0.34, 7.0, np.round(rng.lognormal(0, 3, 6000), 3))
    df = column(spark, [float(x) for x in data]).withColumn("n", F.when(F.col("row_id") > 10, F.col("v") * -1))
    monkeypatch.setattr(O, "BRACKET_VALUES", 20)
    monkeypatch.setattr(O, "SKETCH_ACCURACY", 100)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    got = O.exact_quantiles(df, ["v", "n"], probs, small_rows=10)
    assert np.allclose(got["v"], np.quantile(data, probs), rtol=1e-12)
    assert np.allclose(got["n"], np.quantile(-data[11:], probs), rtol=1e-12)
    monkeypatch.setattr(O, "BUFFERED_VALUES", 6000)  # one column per pass
    assert O.exact_quantiles(df, ["v", "n"], probs)["v"] == pytest.approx(got["v"])


def test_ranked_values_and_cutoffs(spark):
    df = column(spark, [10.0, 9.9, 5.0, 4.9, 4.8, 4.7])
    gap = G.largest_gap(df, "v", 0.0, 1.0)
    assert gap.rank == 2 and gap.threshold == 9.9
    assert G.largest_gap(column(spark, [1.0] * 8), "v", 0.0, 1.0).rank == 1
    data = [5.0, 1.0, 3.0, 3.0, 3.0, 9.0]
    rows = O.ranked_values(column(spark, data), "v").orderBy("value").collect()
    assert [(r["value"], r["n"], r["upto"], r["dense"], r["next_value"]) for r in rows] == [
        (1.0, 1, 1, 1, 3.0), (3.0, 3, 4, 2, 5.0), (5.0, 1, 5, 3, 9.0), (9.0, 1, 6, 4, None)]
    curve = [0.1, 0.1, 0.2, 0.3, 0.4, 5.0]
    chord = [curve[0] + (curve[-1] - curve[0]) * i / 5 for i in range(6)]
    knee = G.knee_chord(column(spark, curve), "v")
    assert knee.rank == int(np.argmax(np.array(chord) - curve)) and knee.value == 0.4
    assert sum(values(G.top_fraction(column(spark, [1.0, 2.0, 2.0, 2.0]), "v", 0.25), "in_top")) == 3


def test_sampling(spark, monkeypatch):
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    small = {r[0] for r in W.sample_exact(df, 700, 9).collect()}
    monkeypatch.setattr(W, "PLAIN_ROWS", 10)
    assert {r[0] for r in W.sample_exact(df, 700, 9).collect()} == small
    monkeypatch.setattr(W, "TOP_ROWS", 10)
    assert {r[0] for r in W.sample_exact(df.repartition(7), 700, 9).collect()} == small and len(small) == 700
    assert W.sample_exact(df, 9000, 9).count() == 5000
    by = df.withColumn("g", F.when(F.col("row_id") < 3, "few").otherwise("many"))
    assert dict(W.stratified_sample(by, "g", 10, 1).groupBy("g").count().collect()) == {"few": 3, "many": 10}


def test_correlation_paths_agree(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(1000, 1, (300, 5))
    x[:, 1] += x[:, 0]
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    cols = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    plain = R.pair_correlations(df, cols)
    _, cov, _ = R.covariance(df, cols)
    monkeypatch.setattr(R, "EXPRESSION_PAIRS", 0)
    gram = R.pair_correlations(df.repartition(3), cols)
    assert [p[:2] for p in plain] == [g[:2] for g in gram]
    assert np.allclose([p[2] for p in plain], [g[2] for g in gram], atol=1e-9)
    assert np.allclose(R.covariance(df, cols)[1], cov, atol=1e-9)


def test_selection_rules():
    pairs = [("a", "b", 0.95), ("b", "c", -0.97), ("a", "c", 0.90), ("t", "a", 0.99)]
    assert S.redundant_columns(pairs, 0.85, [], "t") == ["a", "c"]
    assert S.redundant_columns([("a", "b", 0.9)], 0.85, ["b"]) == ["a"]
    corr = {("x", "y"): 0.9, ("x", "z"): 0.1, ("y", "z"): 0.2}
    assert S.hybrid_subset(["x"], ["y", "z", "w"], corr, 3, 0.7) == ["x", "z", "w"]


def test_special_functions(spark):
    assert chi2_quantile(0.999, 11) == pytest.approx(31.26413, abs=1e-4)
    assert chi2_quantile(0.5, 200) == pytest.approx(199.334, abs=1e-2)
    got = values(column(spark, [1.0, 2.0, 10.0, 1000.0]).withColumn("d", digamma(F.col("v"))), "d")
    assert np.allclose(got, [-0.5772156649015329, 0.42278433509846714, 2.2517525890667212, 6.907255195648813], atol=1e-12)


def test_constant_column_has_no_flags(spark):
    df = column(spark, [3.0] * 20)
    assert A.zscore_flags(df, ["v"]).where("flag_z").count() == 0
    assert set(values(C.standardize(df, ["v"]), "v")) == {0.0}
    shape = P.shape_profile(df, ["v"]).first()
    assert shape["skew"] == 0.0 and shape["kurtosis"] == 0.0


def test_pca_signs_and_variance(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 1))
    x = np.hstack([base, 2 * base + rng.normal(size=(200, 1)) * 0.1, rng.normal(size=(200, 1))])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id int, a double, b double, c double")
    scores, fit = reduction.pca_reduce(df, ["a", "b", "c"], 0.95)
    u = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(fit.ratios, u.S**2 / (u.S**2).sum())
    got = np.array([r[1:] for r in scores.orderBy("row_id").collect()])
    assert np.allclose(got.mean(axis=0), 0, atol=1e-9) and got.shape[1] == fit.count_for(0.95)
    assert all(fit.loadings[np.abs(fit.loadings[:, i]).argmax(), i] > 0 for i in range(3))


def test_rules_with_larger_consequents(spark):
    data = [["a", "b", "c"], ["a", "b", "c"], ["a", "b"], ["c"]]
    df = spark.createDataFrame(list(enumerate(data)), "row_id int, items array<string>")
    sets = U.frequent_itemsets(df, 0.5, 4)
    assert sets.count() == 7
    rules = U.generate_rules(sets)
    assert rules.count() == 12
    hit = rules.where("antecedent = array('a') and consequent = array('b', 'c')").first()
    assert hit["support"] == 0.5 and hit["confidence"] == pytest.approx(2 / 3) and hit["lift"] == pytest.approx(4 / 3)
    supports = {tuple(r["items"]): r["support"] for r in sets.collect()}
    for items, s in supports.items():  # every part of a frequent set is at least as frequent
        assert all(supports[tuple(x for x in items if x != i)] >= s for i in items if len(items) > 1)


def test_agreement(spark):
    df = spark.createDataFrame([(i % 3, i % 3 + 5, i // 30) for i in range(90)], "a int, same int, other int")
    assert K.adjusted_rand(df, "a", "same").first()[0] == pytest.approx(1.0)
    assert abs(K.adjusted_rand(df, "a", "other").first()[0]) < 0.05


def test_silhouette(spark):
    pts = [(0, 0.0, 0.0, 0), (1, 0.0, 1.0, 0), (2, 5.0, 5.0, 1), (3, 5.0, 6.0, 1), (4, 9.0, 0.0, 2)]
    df = spark.createDataFrame(pts, "row_id int, x double, y double, label int")
    got = {r["row_id"]: r["silhouette"] for r in K.silhouette_samples(df, ["x", "y"], "label", None).collect()}
    assert got[4] == 0.0
    b = min((math.dist((0, 0), (5, 5)) + math.dist((0, 0), (5, 6))) / 2, 9.0)
    assert got[0] == pytest.approx((b - 1) / b)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102)]
    rng = np.random.default_rng(0)
    name = dict(enumerate(rng.permutation(200)))
    edges = spark.createDataFrame([(int(name[a]), int(name[b])) for a, b in chain], "a bigint, b bigint")
    nodes = spark.createDataFrame([(int(name[i]),) for i in [*range(1, 61), 100, 101, 102, 150]], "id bigint")
    got = {r["id"]: r["label"] for r in connected_components(nodes, edges).collect()}
    groups = [range(1, 61), (100, 101, 102), (150,)]
    for g in groups:
        assert {got[int(name[i])] for i in g} == {min(int(name[i]) for i in g)}


def plain_dbscan(x, eps, m):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    near = d <= eps
    core = near.sum(axis=1) >= m
    label, regions = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack = [i]
            while stack:
                j = stack.pop()
                if core[j] and label[j] < 0:
                    label[j] = regions
                    stack += list(np.nonzero(near[j] & core & (label < 0))[0])
            regions += 1
    for i in range(len(x)):
        touch = near[i] & core
        if not core[i] and touch.any():
            label[i] = label[touch].min()
    return label, core


@pytest.mark.parametrize("split", [4096, 40])
def test_density_matches_brute_force(spark, monkeypatch, split):
    """Blobs, a third of all rows in one tiny spot, repeated points, a bridge and far points."""
    monkeypatch.setattr(D, "COMPARED_PAIRS", split)
    monkeypatch.setattr(B, "SLICE_POINTS", 25)
    rng = np.random.default_rng(5)
    x = np.vstack([
        rng.normal((0, 0), 0.3, (90, 2)), rng.normal((3, 0), 0.3, (90, 2)), rng.normal((1, 3), 1e-4, (110, 2)),
        np.tile([[5.0, 5.0]], (20, 1)), [[1.5, 0.0], [1.2, 0.1], [1.8, -0.1], [40.0, 40.0]], rng.uniform(-2, 6, (20, 2)),
    ])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "row_id int, x double, y double")
    for eps, m in ((0.4, 6), (1e-4, 8)):
        want, core = plain_dbscan(x, eps, m)
        rows = D.dbscan(df.repartition(5), ["x", "y"], eps, m).orderBy("row_id").collect()
        assert [r["label"] for r in rows] == want.tolist()
        assert [r["is_core"] for r in rows] == core.tolist()
    d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), axis=1)
    got = B.k_distance(df, ["x", "y"], 9).orderBy("row_id").collect()
    assert np.allclose([r["k_dist"] for r in got], d[:, 8], atol=1e-12)


def test_large_box_pairs_are_split(spark, monkeypatch):
    """Two dense neighbouring cells just beyond and just within the radius."""
    monkeypatch.setattr(D, "COMPARED_PAIRS", 16)
    grid = np.array([(a, b) for a in np.linspace(0, 0.5, 12) for b in np.linspace(0, 0.5, 12)])
    for shift, regions in ((1.5, 1), (1.501, 2)):
        x = np.vstack([grid, grid + (shift, 0.0)])
        df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "row_id int, x double, y double")
        assert D.dbscan(df, ["x", "y"], 1.0 + 1e-12, 5).agg(F.max("label")).first()[0] + 1 == regions


def test_isolation_forest(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(600, 2)), [[9.0, 9.0], [-8.0, 9.0]]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "row_id int, x double, y double")
    one = A.isolation_forest(df, ["x", "y"], 40, 128).orderBy("row_id").collect()
    two = A.isolation_forest(df.repartition(6), ["x", "y"], 40, 128).orderBy("row_id").collect()
    assert one == two
    flagged = {r["row_id"] for r in one if r["flag_if"]}
    assert {600, 601} <= flagged and len(flagged) == 7  # strictly above the 99th percentile of 602
    assert all(0 < r["if_score"] < 1 for r in one)


def test_mahalanobis_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 3)) @ np.array([[1, 2, 0], [0, 1, 1], [0, 0, 50.0]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id int, a double, b double, c double")
    got = values(A.mahalanobis(df, ["a", "b", "c"]), "maha_dist2")
    diff = x - x.mean(axis=0)
    assert np.allclose(got, np.einsum("ij,jk,ik->i", diff, np.linalg.inv(np.cov(x.T)), diff))
