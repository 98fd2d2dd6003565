"""Clustering, density, rules and anomaly detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebed.catalog.registry import query, r6, rounded
from orebed.catalog.views import CUSTOMERS, FULL, NUMERIC, customer_points, full_profile, table
from orebed.functions.stats import chi2_quantile
from orebed.operators import anomaly as A
from orebed.operators import clustering as K
from orebed.operators import columns as C
from orebed.operators import density as D
from orebed.operators import neighbors as B
from orebed.operators import profile as P
from orebed.operators import ranking as G
from orebed.operators import rules as R
from orebed.operators import sampling as W
from orebed.operators.align import cross_reference, flag_membership, take_rows
from orebed.operators.reduction import project_2d
from orebed.plans import studies
from orebed.session import cut_lineage

FP = "WITH " + FULL
CU = "WITH " + CUSTOMERS
XY = ["x", "y"]
EPS, MIN_SAMPLES = 0.35, 7  # 7 = round(ln 1500)
FLAGS = ["flag_iqr", "flag_z", "flag_maha"]


def union(parts):
    return " UNION ALL ".join(parts)


def full(spark, sf):
    return cut_lineage(full_profile(spark, sf))


def points(spark, sf):
    return cut_lineage(customer_points(spark, sf))


def scaled(spark, sf):
    return cut_lineage(C.standardize(full(spark, sf), NUMERIC).select("row_id", *NUMERIC))


# -- clustering ---------------------------------------------------------------


@query("c1_kmeans")
def c1(spark, sf):
    df = scaled(spark, sf)
    return K.assign_nearest(df, K.kmeans_fit(df, NUMERIC, 2, 10)).select("row_id", "cluster")


CENTERS = K.Centers(("o_totalprice", "c_acctbal"), ((100000.0, 2000.0), (250000.0, 8000.0), (400000.0, 4000.0)), 0.0)
D2 = [f"(o_totalprice - {a}) ** 2 + (c_acctbal - {b}) ** 2" for a, b in CENTERS.points]


@query("c2_assign_nearest", FP + "SELECT cluster, count(*) AS n, round(sum(d) / 1e6, 4) AS inertia FROM (SELECT least(" + ", ".join(D2) + ") AS d, CASE WHEN " + f"{D2[0]} <= least({D2[1]}, {D2[2]}) THEN 0 WHEN {D2[1]} <= {D2[2]} THEN 1 ELSE 2 END AS cluster FROM fullp) GROUP BY cluster")
def c2(spark, sf):
    return K.inertia(full_profile(spark, sf), CENTERS).select("cluster", "n", F.round(F.col("inertia") / 1e6, 4).alias("inertia"))


@query("c3_k_scan")
def c3(spark, sf):
    return K.k_scan(scaled(spark, sf), NUMERIC, tuple(range(2, 9)), (0, 1, 2, 3, 4), 40_000, 8_000, n_init=5)[0]


SIL = """
pick AS (SELECT row_id, x, y, big FROM cust),
d AS (SELECT a.row_id, a.big AS mine, b.big AS theirs, sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS s, count(*) AS n
      FROM pick a, pick b GROUP BY 1, 2, 3),
sil AS (SELECT row_id, mine AS big, CASE WHEN max(n) FILTER (theirs = mine) = 1 THEN 0.0 ELSE
        (min(s / n) FILTER (theirs <> mine) - max(s / (n - 1)) FILTER (theirs = mine))
        / greatest(min(s / n) FILTER (theirs <> mine), max(s / (n - 1)) FILTER (theirs = mine)) END AS silhouette
        FROM d GROUP BY row_id, mine)
"""


@query("c4_silhouette", f"{CU}, {SIL} SELECT count(*) AS n, {r6('avg(silhouette)')} AS silhouette FROM sil")
def c4(spark, sf):
    return rounded(K.silhouette_exact(points(spark, sf), XY, "big", None), ["silhouette"])


@query("c5_silhouette_fast", CU + ", g AS (SELECT big AS g, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS q FROM cust GROUP BY 1), d AS (SELECT row_id, big, g, n, (x * x + y * y) * n + q - 2 * (x * sx + y * sy) AS s FROM cust, g), s AS (SELECT row_id, max(s / (n - 1)) FILTER (g = big) AS a, min(s / n) FILTER (g <> big) AS b FROM d GROUP BY row_id, big) SELECT " + r6("avg((b - a) / greatest(a, b))") + " AS silhouette FROM s")
def c5(spark, sf):
    value = K.silhouette_fast(points(spark, sf), XY, "big")
    return rounded(spark.createDataFrame([(value,)], "silhouette double"), ["silhouette"])


@query("c6_silhouette_samples", f"{CU}, {SIL} SELECT row_id, big, {r6('silhouette')} AS silhouette FROM sil")
def c6(spark, sf):
    return rounded(K.silhouette_samples(points(spark, sf), XY, "big", None), ["silhouette"])


@query("c7_cluster_sizes", CU + "SELECT big, count(*) AS n, " + r6("count(*) * 100.0 / sum(count(*)) OVER ()") + " AS pct FROM cust GROUP BY 1")
def c7(spark, sf):
    return rounded(P.value_share(points(spark, sf), "big"), ["pct"])


@query("c8_name_clusters", FP + ", g AS (SELECT c_mktsegment, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)) * 100, 1) AS outcome_pct FROM fullp GROUP BY 1) SELECT c_mktsegment, outcome_pct, CASE WHEN row_number() OVER (ORDER BY outcome_pct, c_mktsegment) = 1 THEN 'Prime' WHEN row_number() OVER (ORDER BY outcome_pct DESC, c_mktsegment DESC) = 1 THEN 'Higher-risk' ELSE 'Mid-risk' END AS segment FROM g")
def c8(spark, sf):
    prof = P.cluster_profile(full_profile(spark, sf), "c_mktsegment", [], F.col("o_orderstatus") == "F")
    return K.name_clusters(prof.drop("size_pct"), "c_mktsegment", "outcome_pct")


KD = f"""
kd AS (SELECT id, list_sort(list(d))[{MIN_SAMPLES}] AS k_dist
       FROM (SELECT a.row_id AS id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM cust a, cust b) GROUP BY id)
"""


@query("j8_nearest_neighbors", f"{CU}, n AS (SELECT a.row_id AS pid, b.row_id AS other, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM cust a, cust b), r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY d, other) AS nn_rank FROM n) SELECT pid, other, {r6('d')} AS dist, CAST(nn_rank AS INTEGER) AS nn_rank FROM r WHERE nn_rank <= 5")
def j8(spark, sf):
    found = B.neighbor_table(points(spark, sf), XY, 5)
    return rounded(found.select("pid", "other", "dist", "nn_rank"), ["dist"])


@query("c9_k_distance", f"{CU}, {KD} SELECT id AS row_id, {r6('k_dist')} AS k_dist FROM kd")
def c9(spark, sf):
    return rounded(B.k_distance(points(spark, sf), XY, MIN_SAMPLES), ["k_dist"])


@query("c10_dbscan_params", f"{CU}, ms AS (SELECT CAST(round(ln(count(*))) AS INTEGER) AS m FROM cust), "
       "kd AS (SELECT id, list_sort(list(d))[any_value(m)] AS v FROM (SELECT a.row_id AS id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM cust a, cust b), ms GROUP BY id), "
       "s AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM kd), e AS (SELECT min(v) AS a, max(v) AS b, max(n) AS n FROM s) "
       f"SELECT m AS min_samples, {r6('v')} AS eps, i AS knee_rank FROM s, e, ms ORDER BY round(a + (b - a) * i / (e.n - 1) - v, 9) DESC, i LIMIT 1")
def c10(spark, sf):
    p = D.dbscan_params(points(spark, sf), XY)
    df = spark.createDataFrame([(p.min_samples, p.eps, p.knee_rank)], "min_samples int, eps double, knee_rank bigint")
    return rounded(df, ["eps"])


def dbscan_sql(eps, min_samples):
    return f"""
nb AS (SELECT a.row_id AS a, b.row_id AS b FROM cust a, cust b WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {eps} * {eps}),
core AS (SELECT a AS id FROM nb GROUP BY a HAVING count(*) >= {min_samples}),
link AS (SELECT a, b FROM nb WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(id, root) AS (SELECT id, id FROM core UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id AND link.b > reach.root),
comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS region FROM comp),
region AS (SELECT nb.a AS id, min(region) AS region FROM nb JOIN numbered ON numbered.id = nb.b GROUP BY nb.a),
db AS (SELECT row_id, CAST(coalesce(region, -1) AS BIGINT) AS label, CAST(row_id IN (SELECT id FROM core) AS INTEGER) AS is_core, CASE WHEN region IS NULL THEN 1 ELSE 0 END AS is_noise
       FROM cust LEFT JOIN region ON id = row_id)
"""


def reach_cte(eps, min_samples):
    return "WITH RECURSIVE " + CUSTOMERS + ", " + dbscan_sql(eps, min_samples)


def density(spark, sf):
    return D.dbscan(points(spark, sf), XY, EPS, MIN_SAMPLES)


@query("c11_dbscan", reach_cte(EPS, MIN_SAMPLES) + " SELECT row_id, label, is_core, is_noise FROM db")
def c11(spark, sf):
    return density(spark, sf).select("row_id", "label", F.col("is_core").cast("int").alias("is_core"), "is_noise")


@query("c12_dbscan_sweep")
def c12(spark, sf):
    return D.dbscan_sweep(points(spark, sf), XY, (5, 10, 12, 15, 20, 30, 50))


@query("c13_noise_share", reach_cte(EPS, MIN_SAMPLES) + " SELECT is_noise, count(*) AS n, " + r6("count(*) * 100.0 / sum(count(*)) OVER ()") + " AS pct FROM db GROUP BY 1")
def c13(spark, sf):
    return rounded(P.value_share(density(spark, sf), "is_noise"), ["pct"])


@query("c14_hierarchical_bisect")
def c14(spark, sf):
    return K.hierarchical_bisect(scaled(spark, sf), NUMERIC, 2).select("row_id", "segment")


LINK = 0.25


@query("c15_linkage_components", reach_cte(LINK, 1) + " SELECT row_id, label FROM db")
def c15(spark, sf):
    return D.linkage_components(points(spark, sf), XY, LINK)


@query("c16_adjusted_rand",
       "WITH o AS (SELECT CAST(o_totalprice > 250000 AS INTEGER) AS a, CAST(o_totalprice > 200000 AS INTEGER) AS b FROM orders), "
       "s AS (SELECT sum(n * (n - 1) / 2.0) AS s FROM (SELECT count(*) AS n FROM o GROUP BY a, b)), ra AS (SELECT sum(n * (n - 1) / 2.0) AS ra FROM (SELECT count(*) AS n FROM o GROUP BY a)), "
       "rb AS (SELECT sum(n * (n - 1) / 2.0) AS rb FROM (SELECT count(*) AS n FROM o GROUP BY b)), t AS (SELECT count(*) * (count(*) - 1) / 2.0 AS t FROM o) "
       f"SELECT {r6('(s - ra * rb / t) / ((ra + rb) / 2 - ra * rb / t)')} AS ari FROM s, ra, rb, t")
def c16(spark, sf):
    o = table(spark, sf, "orders").selectExpr("int(o_totalprice > 250000) AS a", "int(o_totalprice > 200000) AS b")
    return rounded(K.adjusted_rand(o, "a", "b"), ["ari"])


@query("c17_agreement_table", "SELECT a, b, count(*) AS n FROM (SELECT CAST(o_totalprice > 250000 AS INTEGER) AS a, CAST(o_totalprice > 200000 AS INTEGER) AS b FROM orders) GROUP BY 1, 2")
def c17(spark, sf):
    o = table(spark, sf, "orders").selectExpr("int(o_totalprice > 250000) AS a", "int(o_totalprice > 200000) AS b")
    return P.crosstab(o, "a", "b")


@query("c18_noise_profile", reach_cte(EPS, MIN_SAMPLES) + ", j AS (SELECT cust.*, is_noise FROM cust JOIN db USING (row_id)) " + union(f"SELECT '{c}' AS feature, {r6(f'avg({c}) FILTER (is_noise = 0)')} AS core, {r6(f'avg({c}) FILTER (is_noise = 1)')} AS noise FROM j" for c in ("x", "y", "n_orders", "big")))
def c18(spark, sf):
    pts = points(spark, sf)
    joined = pts.join(D.dbscan(pts, XY, EPS, MIN_SAMPLES).select("row_id", "is_noise"), "row_id")
    return rounded(P.compare_groups(cut_lineage(joined), F.col("is_noise") == 1, ["x", "y", "n_orders", "big"], ("core", "noise")), ["core", "noise"])


@query("c18_noise_composition", reach_cte(EPS, MIN_SAMPLES) + " SELECT big, count(*) AS n, " + r6("count(*) * 100.0 / sum(count(*)) OVER ()") + " AS pct FROM cust WHERE row_id IN (SELECT row_id FROM db WHERE is_noise = 1) GROUP BY big")
def c18b(spark, sf):
    pts = points(spark, sf)
    noise = D.dbscan(pts, XY, EPS, MIN_SAMPLES).where("is_noise = 1")
    return rounded(P.value_share(cut_lineage(take_rows(pts, noise)), "big"), ["pct"])


@query("c19_compare_algorithms")
def c19(spark, sf):
    pts = points(spark, sf)
    fit = K.kmeans_fit(pts, XY, 2, 10)
    labels = cut_lineage(K.hierarchical_bisect(K.assign_nearest(pts, fit), XY, 2))
    noise = D.dbscan(pts, XY, EPS, MIN_SAMPLES)
    one = lambda df, name, role, metric: df.select(
        F.lit(name).alias("algorithm"), F.lit(role).alias("role"), metric.alias("metric")
    )
    return K.compare_algorithms([
        one(K.silhouette_exact(labels, XY, "cluster", None), "k-means", "segments", F.col("silhouette")),
        one(K.adjusted_rand(labels, "cluster", "segment"), "bisecting", "agreement", F.col("ari")),
        one(noise.agg((F.avg("is_noise") * 100).alias("v")), "dbscan", "noise share", F.col("v")),
    ])


# -- association rules --------------------------------------------------------

ITEMS = ["price", "balance", "lines", "status", "segment", "priority"]


def item_table(spark, sf):
    inf = float("inf")
    df = full_profile(spark, sf).selectExpr(
        "row_id", "o_totalprice", "c_acctbal", "n_lines", "o_orderstatus AS status", "c_mktsegment AS segment", "o_orderpriority AS priority"
    )
    df = C.cut_bin(df, "o_totalprice", [-inf, 150000, 300000, inf], ["small", "medium", "large"], "price")
    df = C.cut_bin(df, "c_acctbal", [-inf, 0, 5000, inf], ["negative", "low", "high"], "balance")
    df = C.cut_bin(df, "n_lines", [-inf, 2, 5, inf], ["few", "some", "many"], "lines")
    return df.select("row_id", *ITEMS)


def baskets(spark, sf):
    return R.to_baskets(item_table(spark, sf), ITEMS)


BASKETS = FP + """, items AS (SELECT row_id,
  CASE WHEN o_totalprice <= 150000 THEN 'small' WHEN o_totalprice <= 300000 THEN 'medium' ELSE 'large' END AS price,
  CASE WHEN c_acctbal <= 0 THEN 'negative' WHEN c_acctbal <= 5000 THEN 'low' ELSE 'high' END AS balance,
  CASE WHEN n_lines <= 2 THEN 'few' WHEN n_lines <= 5 THEN 'some' ELSE 'many' END AS lines,
  o_orderstatus AS status, c_mktsegment AS segment, o_orderpriority AS priority FROM fullp),
b AS (SELECT row_id, list_sort([""" + ", ".join(f"concat('{c}_', {c})" for c in ITEMS) + """]) AS items FROM items),
i AS MATERIALIZED (SELECT row_id, unnest(items) AS item FROM b),
n AS (SELECT count(*) AS total FROM b),
sets AS MATERIALIZED (
  SELECT [item] AS items, count(*) AS n FROM i GROUP BY ALL
  UNION ALL SELECT [a.item, c.item], count(*) FROM i a JOIN i c ON a.row_id = c.row_id AND a.item < c.item GROUP BY ALL
  UNION ALL SELECT [a.item, c.item, d.item], count(*) FROM i a JOIN i c ON a.row_id = c.row_id AND a.item < c.item JOIN i d ON d.row_id = a.row_id AND c.item < d.item GROUP BY ALL
  UNION ALL SELECT [a.item, c.item, d.item, e.item], count(*) FROM i a JOIN i c ON a.row_id = c.row_id AND a.item < c.item JOIN i d ON d.row_id = a.row_id AND c.item < d.item JOIN i e ON e.row_id = a.row_id AND d.item < e.item GROUP BY ALL),
freq AS MATERIALIZED (SELECT items, array_to_string(items, '|') AS key, len(items) AS size, sets.n, sets.n / total AS support FROM sets, n WHERE sets.n >= ceil(0.04 * total - 1e-9)),
parts AS MATERIALIZED (
  SELECT items, support, list_filter(items, lambda v, k: (m >> (k - 1)) & 1 = 1) AS antecedent,
         list_filter(items, lambda v, k: (m >> (k - 1)) & 1 = 0) AS consequent
  FROM freq, (SELECT unnest(range(1, 15)) AS m) WHERE m < (1 << size) - 1),
halves AS MATERIALIZED (SELECT f.items, f.support, f.antecedent, f.consequent, g.support AS sa
  FROM parts f JOIN freq g ON g.key = array_to_string(f.antecedent, '|')),
rules AS MATERIALIZED (SELECT array_to_string(antecedent, ', ') AS antecedents, array_to_string(consequent, ', ') AS consequents, antecedent, consequent, h.support,
                 h.support / sa AS confidence, h.support / sa / k.support AS lift, h.support - sa * k.support AS leverage,
                 CASE WHEN h.support / sa < 1 THEN (1 - k.support) / (1 - h.support / sa) END AS conviction
          FROM halves h JOIN freq k ON k.key = array_to_string(h.consequent, '|')),
kept AS MATERIALIZED (SELECT * FROM rules WHERE lift > 1.02 AND confidence > 0.3)
"""


@query("r1_to_baskets", BASKETS + "SELECT row_id, array_to_string(items, ', ') AS items FROM b")
def r1(spark, sf):
    return baskets(spark, sf).select("row_id", F.array_join("items", ", ").alias("items"))


def itemsets(spark, sf):
    return R.frequent_itemsets(cut_lineage(baskets(spark, sf)), 0.04, 4)


@query("r2_frequent_itemsets", BASKETS + f"SELECT array_to_string(items, ', ') AS items, CAST(size AS INTEGER) AS size, n, {r6('support')} AS support FROM freq")
def r2(spark, sf):
    return rounded(itemsets(spark, sf).withColumn("items", F.array_join("items", ", ")), ["support"])


MEASURES = ["support", "confidence", "lift", "leverage", "conviction"]
SIDES = "SELECT antecedents, consequents, " + ", ".join(f"{r6(m)} AS {m}" for m in MEASURES)
SHORT = f"SELECT antecedents, consequents, {r6('lift')} AS lift"


def all_rules(spark, sf):
    return R.generate_rules(cut_lineage(itemsets(spark, sf)))


def kept_rules(spark, sf):
    return R.filter_rules(all_rules(spark, sf), 1.02, 0.3)


def shown(df):
    return rounded(R.render_rules(df).select("antecedents", "consequents", "lift"), ["lift"])


@query("r3_generate_rules", BASKETS + SIDES + " FROM rules")
def r3(spark, sf):
    return rounded(R.render_rules(all_rules(spark, sf)), MEASURES)


@query("r5_filter_rules", BASKETS + SIDES + " FROM kept")
def r5(spark, sf):
    return rounded(R.render_rules(kept_rules(spark, sf)), MEASURES)


@query("r7_rule_stats", BASKETS + f"SELECT (SELECT count(*) FROM rules) AS n_before, count(*) AS n_after, {r6('count(*) * 100.0 / (SELECT count(*) FROM rules)')} AS retention_pct, {r6('min(lift)')} AS min_lift, {r6('max(lift)')} AS max_lift FROM kept")
def r7(spark, sf):
    rules = cut_lineage(all_rules(spark, sf))
    return rounded(R.rule_stats(rules, R.filter_rules(rules, 1.02, 0.3)), ["retention_pct", "min_lift", "max_lift"])


@query("r8_rules_towards", BASKETS + SHORT + " FROM rules WHERE contains(consequents, 'price_large') AND regexp_matches(antecedents, 'lines|balance')")
def r8(spark, sf):
    return shown(R.rules_towards(all_rules(spark, sf), "price_large", "lines|balance"))


@query("r9_drop_structural", BASKETS + SHORT + " FROM kept WHERE NOT ((len(antecedent) = 1 AND len(consequent) = 1) AND ((starts_with(antecedent[1], 'lines_') AND starts_with(consequent[1], 'balance_')) OR (starts_with(antecedent[1], 'balance_') AND starts_with(consequent[1], 'lines_'))))")
def r9(spark, sf):
    return shown(R.drop_structural(kept_rules(spark, sf), "lines", "balance"))


@query("r10_rules_without", BASKETS + SHORT + " FROM kept WHERE NOT (contains(antecedents, 'lines_') OR contains(consequents, 'lines_') OR contains(antecedents, 'status_') OR contains(consequents, 'status_'))")
def r10(spark, sf):
    return shown(R.rules_without(kept_rules(spark, sf), ["lines", "status"]))


@query("r10_involving", BASKETS + SHORT + " FROM kept WHERE contains(antecedents, 'URGENT') OR contains(consequents, 'URGENT')")
def r10b(spark, sf):
    return shown(R.involving(kept_rules(spark, sf), "URGENT"))


@query("r11_rule_edges", BASKETS + ", top AS (SELECT * FROM kept ORDER BY round(lift, 12) DESC, antecedents, consequents LIMIT 12), w AS (SELECT *, 1 + 4 * (lift - min(lift) OVER ()) / greatest(max(lift) OVER () - min(lift) OVER (), 1e-9) AS width FROM top), s AS (SELECT unnest(antecedent) AS source, consequent, lift, confidence, width FROM w) SELECT source, unnest(consequent) AS target, " + f"{r6('lift')} AS lift, {r6('confidence')} AS confidence, {r6('width', 4)} AS width FROM s")
def r11(spark, sf):
    return rounded(rounded(R.rule_edges(kept_rules(spark, sf).withColumn("lift", F.round("lift", 12)), 12), ["lift", "confidence"]), ["width"], 4)


@query("r12_short_label", BASKETS + "SELECT item, CASE WHEN starts_with(item, 'price_') THEN substr(item, 7) WHEN starts_with(item, 'status_') THEN substr(item, 8) ELSE replace(item, '_', ' ') END AS label FROM (SELECT DISTINCT item FROM i)")
def r12(spark, sf):
    items = baskets(spark, sf).select(F.explode("items").alias("item")).distinct()
    return items.withColumn("label", R.short_label(F.col("item"), ("price", "status")))


@query("r13_rule_catalogue", BASKETS + "SELECT CASE WHEN contains(consequents, 'price') THEN 'pricing' WHEN contains(consequents, 'status') THEN 'outcome' ELSE 'other' END AS category, count(*) AS n FROM kept GROUP BY 1")
def r13(spark, sf):
    text = F.array_join("consequent", ", ")
    category = F.when(F.contains(text, F.lit("price")), "pricing").when(F.contains(text, F.lit("status")), "outcome").otherwise("other")
    return R.rule_catalogue(kept_rules(spark, sf), category)[1]


# -- anomalies ----------------------------------------------------------------

FEATS = ["o_totalprice", "c_acctbal", "n_lines", "qty_sum", "price_sum", "span_days"]
FENCE = ", q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3, avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in FEATS) + " FROM fullp)"


def fence(c, mult=1.5):
    return f"({c} < {c}_1 - {mult} * ({c}_3 - {c}_1) OR {c} > {c}_3 + {mult} * ({c}_3 - {c}_1))"


def zed(c, thr=2.5):
    return f"(abs(({c} - {c}_m) / {c}_s) > {thr})"


IQR_ANY = "(" + " OR ".join(fence(c) for c in FEATS) + ")"
Z_ANY = "(" + " OR ".join(zed(c) for c in FEATS) + ")"


@query("d1_iqr_flags", FP + FENCE + f" SELECT row_id, CAST({IQR_ANY} AS INTEGER) AS flag_iqr FROM fullp, q")
def d1(spark, sf):
    df = A.iqr_flags(full(spark, sf), FEATS, 1.5)
    return df.select("row_id", F.col("flag_iqr").cast("int").alias("flag_iqr"))


@query("d2_zscore_flags", FP + FENCE + f" SELECT row_id, CAST({Z_ANY} AS INTEGER) AS flag_z FROM fullp, q")
def d2(spark, sf):
    df = A.zscore_flags(full(spark, sf), FEATS, 2.5)
    return df.select("row_id", F.col("flag_z").cast("int").alias("flag_z"))


@query("d3_flag_counts", FP + FENCE + " " + union(f"SELECT '{c}' AS feature, count(*) FILTER ({fence(c)}) AS n_iqr, count(*) FILTER ({zed(c)}) AS n_z FROM fullp, q" for c in FEATS) + f" UNION ALL SELECT 'ANY', count(*) FILTER ({IQR_ANY}), count(*) FILTER ({Z_ANY}) FROM fullp, q")
def d3(spark, sf):
    return A.flag_counts(full(spark, sf), FEATS, 1.5, 2.5)


M2 = ["qty_sum", "span_days"]
CHI = repr(chi2_quantile(0.999, 2))
MAHA = (
    ", mm AS (SELECT avg(qty_sum) AS m1, avg(span_days) AS m2, var_samp(qty_sum) AS a, covar_samp(qty_sum, span_days) AS b, var_samp(span_days) AS d FROM fullp), "
    "md AS (SELECT row_id, ((qty_sum - m1) ** 2 * d - 2 * (qty_sum - m1) * (span_days - m2) * b + (span_days - m2) ** 2 * a) / (a * d - b * b) AS maha_dist2 FROM fullp, mm)"
)


@query("d4_mahalanobis", FP + MAHA + f" SELECT row_id, {r6('maha_dist2')} AS maha_dist2, CAST(maha_dist2 > {CHI} AS INTEGER) AS flag_maha FROM md")
def d4(spark, sf):
    df = A.mahalanobis(full(spark, sf), M2)
    return rounded(df.select("row_id", "maha_dist2", F.col("flag_maha").cast("int").alias("flag_maha")), ["maha_dist2"])


@query("d4_mahalanobis_all")
def d4b(spark, sf):
    df = A.mahalanobis(full(spark, sf), NUMERIC)
    return df.select("row_id", "maha_dist2", "flag_maha")


@query("d5_isolation_forest")
def d5(spark, sf):
    return A.isolation_forest(full(spark, sf), NUMERIC)


@query("d6_isolation_scores")
def d6(spark, sf):
    return A.isolation_scores(full(spark, sf), M2).select("row_id", "if_score")


WINDOWS = [(0.0005, 0.05), (0.0002, 0.03), (0.001, 0.05), (0.0005, 0.10)]


@query("d7_gap_stability", FP + MAHA + ", s AS (SELECT maha_dist2 AS v, row_number() OVER (ORDER BY maha_dist2 DESC) AS rk, maha_dist2 - lead(maha_dist2) OVER (ORDER BY maha_dist2 DESC) AS gap, count(*) OVER () AS n FROM md) "
       + union(f"SELECT * FROM (SELECT CAST({a} AS DOUBLE) AS lo, CAST({b} AS DOUBLE) AS hi, rk AS cut_rank, {r6('rk * 100.0 / n')} AS pct_rows, {r6('gap')} AS gap FROM s WHERE rk > floor(n * {a}) AND rk < floor(n * {b}) ORDER BY round(gap, 9) DESC, rk LIMIT 1)" for a, b in WINDOWS))
def d7(spark, sf):
    df = cut_lineage(A.mahalanobis(full(spark, sf), M2).select("row_id", "maha_dist2"))
    return rounded(G.gap_stability(df, "maha_dist2", WINDOWS), ["pct_rows", "gap"])


FLAGGED = FENCE + MAHA + (
    f", fl AS (SELECT fullp.*, maha_dist2, {IQR_ANY} AS flag_iqr, {Z_ANY} AS flag_z, maha_dist2 > {CHI} AS flag_maha FROM fullp, q, md WHERE md.row_id = fullp.row_id), "
    "cs AS (SELECT *, CAST(flag_iqr AS INTEGER) + CAST(flag_z AS INTEGER) + CAST(flag_maha AS INTEGER) AS n_methods FROM fl)"
)


def flagged(spark, sf):
    df = full(spark, sf)
    df = A.mahalanobis(A.zscore_flags(A.iqr_flags(df, FEATS, 1.5), FEATS, 2.5), M2)
    return A.consensus(df, FLAGS)


@query("d8_consensus_sensitivity", FP + FLAGGED + ", c AS (SELECT *, CAST(flag_iqr AS INTEGER) + CAST(flag_z AS INTEGER) AS base, "
       "(SELECT v FROM (SELECT maha_dist2 AS v, row_number() OVER (ORDER BY maha_dist2 DESC) AS rk FROM md), (SELECT count(*) AS n FROM md) WHERE rk = floor(n * 0.05)) AS top5, "
       "(SELECT v FROM (SELECT maha_dist2 AS v, row_number() OVER (ORDER BY maha_dist2 DESC) AS rk, maha_dist2 - lead(maha_dist2) OVER (ORDER BY maha_dist2 DESC) AS gap, count(*) OVER () AS n FROM md) "
       "WHERE rk > floor(n * 0.0005) AND rk < floor(n * 0.05) ORDER BY round(gap, 9) DESC, rk LIMIT 1) AS at_gap FROM fl) "
       "SELECT 'gap' AS cutoff, count(*) FILTER (maha_dist2 >= at_gap - 1e-9) AS flagged, count(*) FILTER (base + CAST(maha_dist2 >= at_gap - 1e-9 AS INTEGER) >= 2) AS confirmed FROM c UNION ALL "
       "SELECT 'flag' AS cutoff, count(*) FILTER (flag_maha) AS flagged, count(*) FILTER (base + CAST(flag_maha AS INTEGER) >= 2) AS confirmed FROM c UNION ALL SELECT 'top_0.05', count(*) FILTER (maha_dist2 >= top5), count(*) FILTER (base + CAST(maha_dist2 >= top5 AS INTEGER) >= 2) FROM c")
def d8(spark, sf):
    df = cut_lineage(flagged(spark, sf))
    masks = A.score_cutoffs(df, "maha_dist2", "flag_maha")
    return A.consensus_sensitivity(df, ["flag_iqr", "flag_z"], masks)


@query("d9_consensus", FP + FLAGGED + " SELECT row_id, n_methods, CAST(n_methods >= 1 AS INTEGER) AS candidate, CAST(n_methods >= 2 AS INTEGER) AS confirmed FROM cs")
def d9(spark, sf):
    return flagged(spark, sf).select("row_id", "n_methods", F.col("candidate").cast("int").alias("candidate"), F.col("confirmed").cast("int").alias("confirmed"))


@query("d9_consensus_counts", FP + FLAGGED + " SELECT " + ", ".join(f"count(*) FILTER ({f}) AS {f}" for f in FLAGS) + ", " + ", ".join(f"count(*) FILTER (n_methods >= {k}) AS at_least_{k}" for k in (1, 2, 3)) + " FROM cs")
def d9b(spark, sf):
    return A.consensus_counts(flagged(spark, sf), FLAGS)


RISK = ["n_lines", "qty_sum", "price_sum", "span_days"]
CLASSED = FLAGGED + (
    ", e AS (SELECT *, n_methods >= 2 AS confirmed, n_methods >= 2 AND (o_totalprice > 480000 OR qty_sum > 300) AS data_error, "
    + " + ".join(f"({c} - (SELECT avg({c}) FROM fullp)) / (SELECT stddev_pop({c}) FROM fullp)" for c in RISK)
    + " AS risk_score FROM cs), t AS (SELECT quantile_cont(risk_score, 0.9) AS cut FROM e WHERE confirmed AND NOT data_error), "
    "cl AS (SELECT e.*, confirmed AND NOT data_error AND risk_score >= cut - 1e-12 AS risk_signal, CASE WHEN data_error THEN 'data_error' WHEN confirmed AND risk_score >= cut - 1e-12 THEN 'risk_signal' WHEN confirmed THEN 'rare_case' END AS classification FROM e, t)"
)


def errors(spark, sf):
    return A.rule_flag(flagged(spark, sf), (F.col("o_totalprice") > 480000) | (F.col("qty_sum") > 300))


def classed(spark, sf):
    return A.classify(A.risk_score(cut_lineage(errors(spark, sf)), RISK))


@query("d10_data_error", FP + CLASSED + " SELECT row_id, CAST(data_error AS INTEGER) AS data_error FROM cl WHERE confirmed")
def d10(spark, sf):
    return errors(spark, sf).where("confirmed").select("row_id", F.col("data_error").cast("int").alias("data_error"))


@query("d11_risk_score", FP + CLASSED + f" SELECT row_id, {r6('risk_score')} AS risk_score, CAST(risk_signal AS INTEGER) AS risk_signal FROM cl")
def d11(spark, sf):
    df = A.risk_score(cut_lineage(errors(spark, sf)), RISK)
    return rounded(df.select("row_id", "risk_score", F.col("risk_signal").cast("int").alias("risk_signal")), ["risk_score"])


BAD = "avg(CAST(o_orderstatus = 'F' AS INTEGER)) * 100"


@query("d12_outcome_validation", FP + CLASSED + f", b AS (SELECT {BAD} AS base FROM cl) " + union(f"SELECT '{n}' AS subset, count(*) AS n, {r6(BAD)} AS rate_pct, {r6(BAD + ' / any_value(base)')} AS lift FROM cl, b WHERE {w}" for n, w in (("all", "true"), ("anomalies", "confirmed"), ("risk_signal", "risk_signal"))))
def d12(spark, sf):
    df = classed(spark, sf)
    return rounded(P.rate_by(df, F.col("o_orderstatus") == "F", {"anomalies": F.col("confirmed"), "risk_signal": F.col("risk_signal")}), ["rate_pct", "lift"])


@query("d13_classify", FP + CLASSED + " SELECT row_id, classification FROM cl WHERE confirmed")
def d13(spark, sf):
    return classed(spark, sf).where("confirmed").select("row_id", "classification")


NOISE = "SELECT o_orderkey AS row_id FROM orders WHERE o_totalprice > 495000"
TYPED = CLASSED + f", ty AS (SELECT *, CASE WHEN row_id IN ({NOISE}) THEN 'collective' WHEN flag_iqr OR flag_z THEN 'point' ELSE 'contextual' END AS outlier_type FROM cl WHERE confirmed)"


def typed(spark, sf):
    noise = table(spark, sf, "orders").where("o_totalprice > 495000").select(F.col("o_orderkey").alias("row_id"))
    return A.outlier_type(flag_membership(classed(spark, sf), noise, "in_noise"), "in_noise", ["flag_iqr", "flag_z"])


@query("d14_outlier_type", FP + TYPED + " SELECT row_id, outlier_type FROM ty")
def d14(spark, sf):
    return typed(spark, sf).where("confirmed").select("row_id", "outlier_type")


def report(spark, sf):
    df = A.anomaly_report(typed(spark, sf), M2, "o_orderstatus", FLAGS)
    return df.withColumns({f: F.col(f).cast("int") for f in FLAGS})


REPORT = "rep AS (SELECT row_id, qty_sum, span_days, o_orderstatus, n_methods, " + ", ".join(f"CAST({f} AS INTEGER) AS {f}" for f in FLAGS) + f", {r6('maha_dist2', 1)} AS maha_dist2, {r6('risk_score', 2)} AS risk_score, classification, outlier_type FROM ty)"


@query("d15_anomaly_report", FP + TYPED + f", {REPORT} SELECT * FROM rep")
def d15(spark, sf):
    return rounded(report(spark, sf), ["maha_dist2", "risk_score"], 2)


@query("d16_examples_per_class", FP + TYPED + f", {REPORT} SELECT row_id, classification, maha_dist2, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY classification ORDER BY maha_dist2 DESC, row_id) AS rank FROM rep) WHERE rank <= 5")
def d16(spark, sf):
    df = report(spark, sf).select("row_id", "classification", "maha_dist2")
    return W.top_k_per_group(df, "classification", [F.desc("maha_dist2"), "row_id"], 5)


@query("d_four_methods")
def d_all(spark, sf):
    """The whole anomaly study with the isolation forest and the density noise of the projection."""
    df = full(spark, sf)
    plane = cut_lineage(project_2d(C.standardize(df, NUMERIC), NUMERIC))
    noise = D.dbscan(plane, XY, 0.5, 10).where("is_noise = 1")
    out = studies.flag_anomalies(df, NUMERIC, F.col("o_totalprice") > 480000, RISK, noise)
    return out.where("confirmed").select("row_id", "n_methods", "classification", "outlier_type")


@query("j4_noise_cross_reference")
def j4_noise(spark, sf):
    df = full(spark, sf)
    plane = cut_lineage(project_2d(C.standardize(df, NUMERIC), NUMERIC))
    noise = D.dbscan(plane, XY, 0.5, 10).where("is_noise = 1")
    flags = A.consensus(A.zscore_flags(A.iqr_flags(df, FEATS, 1.5), FEATS, 2.5), ["flag_iqr", "flag_z"])
    return cross_reference(noise, flags)

