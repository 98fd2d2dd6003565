"""Profiling, windows and samples, feature selection and reduction."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebed.catalog.q_basic import WITH, profile
from orebed.catalog.registry import query, r6, rounded
from orebed.catalog.views import (
    CUSTOMERS, EVENT_COLUMNS, EVENTS, FULL, NUMERIC, customer_points, event_values, full_profile, order_profile,
    table,
)
from orebed.config import MiningConfig
from orebed.functions.orderstats import ranked_values
from orebed.operators import columns as C
from orebed.operators import correlation as R
from orebed.operators import profile as P
from orebed.operators import ranking as G
from orebed.operators import reduction as D
from orebed.operators import sampling as W
from orebed.operators import selection as S
from orebed.plans.preparation import prepare
from orebed.session import cut_lineage

NUMS = ["o_totalprice", "n_lines", "qty_sum", "disc_avg", "mths_since_return", "ev_sum"]


def union(parts):
    return " UNION ALL ".join(parts)


# -- profiling ----------------------------------------------------------------


@query("a1_type_profile", "SELECT CASE WHEN data_type = 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS dtype, count(*) AS n_columns FROM (DESCRIBE SELECT * FROM (WITH " + "x AS (SELECT 1) SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)) AS d(column_name, data_type, a, b, c, e) GROUP BY 1")
def a1(spark, sf):
    return P.type_profile(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))


def _describe(c, src="profile", scale=""):
    return (
        f"SELECT '{c}' AS feature, count({c}) AS n, {r6(f'avg({c})', 4)} AS mean, {r6(f'stddev_samp({c})', 4)} AS std, "
        f"min({c}) AS min, {r6(f'quantile_cont({c}, 0.25)', 4)} AS q25, {r6(f'quantile_cont({c}, 0.5)', 4)} AS q50, "
        f"{r6(f'quantile_cont({c}, 0.75)', 4)} AS q75, max({c}) AS max FROM {src}"
    )


@query("a2_describe_numeric", WITH + union(_describe(c) for c in NUMS))
def a2(spark, sf):
    return rounded(P.describe_numeric(profile(spark, sf), NUMS), ["mean", "std", "q25", "q50", "q75"], 4)


@query("a3_skewness", WITH + union(f"SELECT '{c}' AS feature, {r6(f'skewness({c})')} AS skew FROM profile" for c in NUMS))
def a3(spark, sf):
    return rounded(P.shape_profile(order_profile(spark, sf), NUMS).select("feature", "skew"), ["skew"])


@query("a4_kurtosis", WITH + union(f"SELECT '{c}' AS feature, {r6(f'kurtosis({c})')} AS kurtosis FROM profile" for c in NUMS))
def a4(spark, sf):
    return rounded(P.shape_profile(order_profile(spark, sf), NUMS).select("feature", "kurtosis"), ["kurtosis"])


def _outlier(c, k, src="profile"):
    return (
        f"SELECT '{c}' AS feature, {r6(f'avg(CASE WHEN {c} < a - {k} * (b - a) OR {c} > b + {k} * (b - a) THEN 1.0 ELSE 0.0 END) * 100')} AS outlier_pct "
        f"FROM {src}, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM {src}) WHERE {c} IS NOT NULL"
    )


@query("a5_iqr_outlier_pct", WITH + union(_outlier(c, 1.5) for c in NUMS))
def a5(spark, sf):
    return rounded(P.iqr_outlier_pct(profile(spark, sf), NUMS), ["outlier_pct"])


@query("a6_numeric_profile", WITH + f"SELECT d.*, skew, kurtosis, missing_pct, outlier_pct FROM ({union(_describe(c) for c in NUMS)}) d JOIN ("
       + union(f"SELECT '{c}' AS feature, {r6(f'skewness({c})', 4)} AS skew, {r6(f'kurtosis({c})', 4)} AS kurtosis, {r6(f'avg(CAST({c} IS NULL AS INTEGER)) * 100', 4)} AS missing_pct FROM profile" for c in NUMS)
       + ") s USING (feature) JOIN (SELECT feature, round(outlier_pct, 4) + 0.0 AS outlier_pct FROM (" + union(_outlier(c, 1.5) for c in NUMS) + ")) o USING (feature)")
def a6(spark, sf):
    df = P.numeric_profile(profile(spark, sf), NUMS)
    return rounded(df, ["mean", "std", "q25", "q50", "q75", "skew", "kurtosis", "missing_pct", "outlier_pct"], 4)


def _cat(c, src):
    return (
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_unique, (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
        f"{r6(f'(SELECT count(*) FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) * 100.0 / count(*)', 2)} AS top_freq_pct, "
        f"{r6(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)', 2)} AS missing_pct FROM {src}"
    )


@query("a7_categorical_profile", "WITH c AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS partial FROM orders) " + union(_cat(c, "c") for c in ("o_orderstatus", "o_orderpriority", "partial")))
def a7(spark, sf):
    df = table(spark, sf, "orders").withColumn("partial", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    return P.categorical_profile(df, ["o_orderstatus", "o_orderpriority", "partial"])


@query("a8_value_counts_topk", "WITH v AS (" + union(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("p_brand", "p_type", "p_name"))
       + "), k AS (SELECT feature FROM v GROUP BY feature HAVING count(*) <= 25) SELECT feature, value, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rank FROM v WHERE feature IN (SELECT feature FROM k)) WHERE rank <= 10")
def a8(spark, sf):
    return P.value_counts_topk(table(spark, sf, "part"), ["p_brand", "p_type", "p_name"], 10, 25)


CORR = ["o_totalprice", "n_lines", "qty_sum", "price_sum", "disc_avg", "span_days", "mths_since_return", "ev_n", "ev_sum"]
PAIRS = [(a, b) for i, a in enumerate(CORR) for b in CORR[i + 1:]]
UPPER = union(f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS r FROM profile" for a, b in PAIRS)


@query("a9_corr_matrix", WITH + f", u AS ({UPPER}) SELECT * FROM u UNION ALL SELECT b, a, r FROM u UNION ALL " + union(f"SELECT '{c}', '{c}', 1.0" for c in CORR))
def a9(spark, sf):
    return rounded(R.corr_matrix(profile(spark, sf), CORR), ["r"])


WIDE = CORR + [f"{c}_sq" for c in CORR] + [f"{c}_inv" for c in CORR]


@query("a9_corr_matrix_wide", WITH + ", w AS (SELECT " + ", ".join(CORR + [f"{c} * {c} / 1000 AS {c}_sq" for c in CORR] + [f"1 / (1 + abs({c})) AS {c}_inv" for c in CORR]) + " FROM profile) "
       + union(f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})', 5)} AS r FROM w" for i, a in enumerate(WIDE) for b in WIDE[i + 1:]))
def a9w(spark, sf):
    df = profile(spark, sf).selectExpr(*CORR, *[f"{c} * {c} / 1000 AS {c}_sq" for c in CORR], *[f"1 / (1 + abs({c})) AS {c}_inv" for c in CORR])
    rows = spark.createDataFrame(R.pair_correlations(df, WIDE), "a string, b string, r double")
    return rounded(rows, ["r"], 5)


@query("a10_high_corr_pairs", WITH + f"SELECT * FROM ({UPPER}) WHERE abs(r) > 0.7")
def a10(spark, sf):
    return rounded(R.high_corr_pairs(order_profile(spark, sf), CORR, 0.7), ["r"])


@query("a11_max_abs_corr", WITH + f"SELECT max(abs(r)) AS max_abs_r FROM ({UPPER})")
def a11(spark, sf):
    return rounded(R.max_abs_corr(order_profile(spark, sf), CORR), ["max_abs_r"])


def _hist(c):
    """Edge by edge: the bin is the number of edges at or below the value."""
    edges = " + ".join(f"CAST({c} >= lo + {i} * ((hi - lo) / 40) AS INTEGER)" for i in range(1, 40))
    return (
        f"SELECT '{c}' AS feature, 1 + {edges} AS bucket, count(*) AS n "
        f"FROM profile, (SELECT min({c}) AS lo, max({c}) AS hi FROM profile) WHERE {c} IS NOT NULL GROUP BY 2"
    )


@query("a12_histogram", WITH + union(_hist(c) for c in NUMS))
def a12(spark, sf):
    return P.histogram(profile(spark, sf), NUMS, 40)


def _box(c):
    lo, hi = "q25 - 1.5 * (q75 - q25)", "q75 + 1.5 * (q75 - q25)"
    return (
        f"SELECT '{c}' AS feature, min({c}) FILTER ({c} >= {lo}) AS whisker_low, any_value(round(q25, 6)) AS q25, any_value(round(q50, 6)) AS q50, any_value(round(q75, 6)) AS q75, "
        f"max({c}) FILTER ({c} <= {hi}) AS whisker_high, count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS fliers "
        f"FROM profile, (SELECT quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75 FROM profile)"
    )


@query("a13_boxplot_stats", WITH + union(_box(c) for c in NUMS))
def a13(spark, sf):
    return rounded(P.boxplot_stats(profile(spark, sf), NUMS), ["q25", "q50", "q75"])


@query("a14_skew_ranking", "WITH " + EVENTS + union(f"SELECT '{c}' AS feature, {r6(f'skewness({c})', 4)} AS skew FROM evv" for c in ("value", "heavy", "spike", "user_id")))
def a14(spark, sf):
    return rounded(P.skew_ranking(event_values(spark, sf), ["value", "heavy", "spike", "user_id"]), ["skew"], 4)


@query("a15_value_share", "SELECT o_orderpriority, count(*) AS n, " + r6("count(*) * 100.0 / sum(count(*)) OVER ()") + " AS pct FROM orders GROUP BY 1")
def a15(spark, sf):
    return rounded(P.value_share(table(spark, sf, "orders"), "o_orderpriority"), ["pct"])


@query("a16_distinct_sorted", "SELECT DISTINCT p_brand FROM part")
def a16(spark, sf):
    return P.distinct_sorted(table(spark, sf, "part"), "p_brand")


@query("a17_scalars", "SELECT min(o_totalprice) AS min, max(o_totalprice) AS max, " + r6("avg(o_totalprice)", 4) + " AS mean, " + r6("median(o_totalprice)", 4) + " AS median FROM orders")
def a17(spark, sf):
    return rounded(P.scalars(table(spark, sf, "orders"), "o_totalprice"), ["mean", "median"], 4)


@query("a18_rate_by", "WITH b AS (SELECT avg(CAST(o_orderstatus = 'F' AS INTEGER)) * 100 AS base FROM orders) "
       + union(f"SELECT '{n}' AS subset, count(*) AS n, {r6('avg(CAST(o_orderstatus = ' + chr(39) + 'F' + chr(39) + ' AS INTEGER)) * 100')} AS rate_pct, "
               f"{r6('avg(CAST(o_orderstatus = ' + chr(39) + 'F' + chr(39) + ' AS INTEGER)) * 100 / any_value(base)')} AS lift FROM orders, b WHERE {w}"
               for n, w in (("all", "true"), ("large", "o_totalprice > 400000"), ("urgent", "o_orderpriority = '1-URGENT'"))))
def a18(spark, sf):
    masks = {"large": F.col("o_totalprice") > 400000, "urgent": F.col("o_orderpriority") == "1-URGENT"}
    return rounded(P.rate_by(table(spark, sf, "orders"), F.col("o_orderstatus") == "F", masks), ["rate_pct", "lift"])


@query("a19_crosstab", "SELECT o_orderpriority, o_orderstatus, count(*) AS n, " + r6("count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY o_orderpriority)") + " AS row_pct FROM orders GROUP BY 1, 2")
def a19(spark, sf):
    return rounded(P.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", True), ["row_pct"])


@query("a19_crosstab_wide", "SELECT quality, count(*) FILTER (toxic = 0) AS \"0\", count(*) FILTER (toxic = 1) AS \"1\" FROM labels GROUP BY quality")
def a19w(spark, sf):
    return P.crosstab_wide(table(spark, sf, "labels"), "quality", "toxic", [0, 1])


@query("a20_cluster_profile", WITH + "SELECT c_mktsegment, round(avg(o_totalprice), 1) AS o_totalprice, round(avg(qty_sum), 1) AS qty_sum, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS size_pct, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)) * 100, 1) AS outcome_pct FROM profile GROUP BY 1")
def a20(spark, sf):
    return P.cluster_profile(order_profile(spark, sf), "c_mktsegment", ["o_totalprice", "qty_sum"], F.col("o_orderstatus") == "F")


@query("a21_profile_zscore", WITH + "SELECT c_mktsegment, " + ", ".join(f"{r6(f'(avg({c}) - (SELECT avg({c}) FROM profile)) / (SELECT stddev_samp({c}) FROM profile)')} AS {c}" for c in ("o_totalprice", "qty_sum", "c_acctbal")) + " FROM profile GROUP BY 1")
def a21(spark, sf):
    cols = ["o_totalprice", "qty_sum", "c_acctbal"]
    return rounded(P.profile_zscore(profile(spark, sf), "c_mktsegment", cols), cols)


@query("a22_compare_groups", WITH + union(f"SELECT '{c}' AS feature, {r6(f'avg({c}) FILTER (o_orderstatus <> ' + chr(39) + 'F' + chr(39) + ')', 4)} AS core, {r6(f'avg({c}) FILTER (o_orderstatus = ' + chr(39) + 'F' + chr(39) + ')', 4)} AS noise FROM profile" for c in ("o_totalprice", "qty_sum", "n_lines")))
def a22(spark, sf):
    df = P.compare_groups(order_profile(spark, sf), F.col("o_orderstatus") == "F", ["o_totalprice", "qty_sum", "n_lines"], ("core", "noise"))
    return rounded(df, ["core", "noise"], 4)


@query("a23_funnel", WITH + ", s AS (" + union(f"SELECT {i} AS step, '{n}' AS stage, count(*) AS rows FROM profile WHERE {w}" for i, (n, w) in enumerate((("raw", "true"), ("with lines", "n_lines IS NOT NULL"), ("with events", "n_lines IS NOT NULL AND ev_n IS NOT NULL")), 1)) + ") SELECT step, stage, rows, " + r6("rows * 100.0 / (SELECT rows FROM s WHERE step = 1)") + " AS pct_initial FROM s")
def a23(spark, sf):
    df = profile(spark, sf)
    return rounded(P.funnel([("raw", df), ("with lines", df.where("n_lines IS NOT NULL")), ("with events", df.where("n_lines IS NOT NULL AND ev_n IS NOT NULL"))]), ["pct_initial"])


@query("a24_scatter_extract", "SELECT row_id, least(o_totalprice, 400000.0) AS o_totalprice, o_custkey, o_orderstatus FROM (SELECT o_orderkey AS row_id, *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat_ws('_', o_orderkey, 42)), o_orderkey) AS rn FROM orders) WHERE rn <= 1000")
def a24(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "row_id")
    return W.scatter_extract(o, "o_totalprice", "o_custkey", "o_orderstatus", 1000, 42, by="o_orderstatus", clip_x=400000)


@query("a25_format_metric", WITH + "SELECT row_id, coalesce(round(ev_sum, 2), 0.0) AS metric_plot, coalesce(printf('%.1f', ev_max), 'N/A') AS label FROM profile")
def a25(spark, sf):
    df = order_profile(spark, sf)
    plot = C.format_metric(df.select("row_id", F.round("ev_sum", 2).alias("metric"), "ev_max"), "metric", 1)
    return C.format_metric(plot, "ev_max", 1).select("row_id", "metric_plot", F.col("ev_max_label").alias("label"))


# -- windows, top-k, samples, cut-offs ----------------------------------------


@query("w1_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def w1(spark, sf):
    return W.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 15)


@query("w2_top_k_per_group", "SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5")
def w2(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return W.top_k_per_group(df, "o_orderpriority", [F.desc("o_totalprice"), "o_orderkey"], 5)


@query("w3_nlargest", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 12")
def w3(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return W.top_k(df, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 12)


@query("w4_stratified_sample", "SELECT event_id AS row_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5(concat_ws('_', event_id, 42)), event_id) AS rn FROM events) WHERE rn <= 2000")
def w4(spark, sf):
    return W.stratified_sample(table(spark, sf, "events").select(F.col("event_id").alias("row_id"), "event_type"), "event_type", 2000, 42)


@query("w5_sample_exact", union(f"SELECT * FROM (SELECT {s} AS seed, event_id FROM events ORDER BY md5(concat_ws('_', event_id, {s})) LIMIT {n})" for s, n in ((0, 500), (1, 500), (42, 4000))))
def w5(spark, sf):
    ev = table(spark, sf, "events")
    return W.union_samples([
        W.sample_exact(ev.select(F.lit(s).alias("seed"), "event_id"), n, s, "event_id") for s, n in ((0, 500), (1, 500), (42, 4000))
    ])


def _gap_sql(score, src, lo, hi):
    return (
        f"SELECT rk AS cut_rank, {r6('v', 4)} AS threshold, {r6('gap')} AS gap FROM (SELECT v, row_number() OVER (ORDER BY v DESC) AS rk, v - lead(v) OVER (ORDER BY v DESC) AS gap, count(*) OVER () AS n FROM (SELECT {score} AS v FROM {src})) "
        f"WHERE rk > CAST(floor(n * {lo}) AS BIGINT) AND rk < CAST(floor(n * {hi}) AS BIGINT) ORDER BY round(gap, 9) DESC, rk LIMIT 1"
    )


@query("w6_largest_gap", _gap_sql("o_totalprice", "orders", 0.0005, 0.05))
def w6(spark, sf):
    g = G.largest_gap(table(spark, sf, "orders"), "o_totalprice", 0.0005, 0.05)
    df = spark.createDataFrame([(g.rank, g.threshold, g.size)], "cut_rank bigint, threshold double, gap double")
    return rounded(rounded(df, ["threshold"], 4), ["gap"])


@query("w7_knee_chord", "WITH " + EVENTS + ", s AS (SELECT heavy AS v, row_number() OVER (ORDER BY heavy) - 1 AS i, count(*) OVER () AS n FROM evv), e AS (SELECT min(v) AS a, max(v) AS b, max(n) AS n FROM s) SELECT i AS knee_rank, round(v, 4) + 0.0 AS value FROM s, e ORDER BY round(a + (b - a) * i / (e.n - 1) - v, 7) DESC, i LIMIT 1")
def w7(spark, sf):
    k = G.knee_chord(event_values(spark, sf), "heavy")
    return rounded(spark.createDataFrame([(k.rank, k.value)], "knee_rank bigint, value double"), ["value"], 4)


@query("w8_components_for", "WITH r AS (SELECT c_nationkey AS component, sum(c_acctbal) / (SELECT sum(c_acctbal) FROM customer) AS ratio FROM customer GROUP BY 1), c AS (SELECT component, ratio, sum(ratio) OVER (ORDER BY component) AS cumulative FROM r) SELECT CAST(component AS INTEGER) AS component, " + r6("ratio") + " AS ratio, " + r6("cumulative") + " AS cumulative, CAST((SELECT min(component) FROM c WHERE cumulative >= 0.9) AS INTEGER) AS n_components FROM c")
def w8(spark, sf):
    c = table(spark, sf, "customer")
    total = c.agg(F.sum("c_acctbal")).first()[0]
    ratios = c.groupBy(F.col("c_nationkey").cast("int").alias("component")).agg((F.sum("c_acctbal") / total).alias("ratio"))
    return rounded(G.components_for(ratios, 0.9), ["ratio", "cumulative"])


@query("w9_winner_by", "SELECT o_orderstatus, count(*) AS wins FROM (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderstatus) AS rn FROM orders) WHERE rn = 1 GROUP BY 1")
def w9(spark, sf):
    return G.winner_by(table(spark, sf, "orders"), "o_custkey", "o_totalprice", "o_orderstatus")


@query("w10_percentile_threshold", "SELECT " + r6("quantile_cont(o_totalprice, 0.9)", 4) + " AS threshold FROM orders WHERE o_orderstatus = 'F'")
def w10(spark, sf):
    t = G.percentile_threshold(table(spark, sf, "orders"), "o_totalprice", 0.9, F.col("o_orderstatus") == "F")
    return rounded(spark.createDataFrame([(t,)], "threshold double"), ["threshold"], 4)


@query("w11_top_fraction", "WITH t AS (SELECT o_totalprice AS cut FROM (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC) AS rk, count(*) OVER () AS n FROM orders) WHERE rk = CAST(floor(n * 0.05) AS BIGINT)) SELECT o_orderkey, CAST(o_totalprice >= cut AS INTEGER) AS in_top FROM orders, t")
def w11(spark, sf):
    df = G.top_fraction(table(spark, sf, "orders"), "o_totalprice", 0.05)
    return df.select("o_orderkey", F.col("in_top").cast("int").alias("in_top"))


@query("w12_global_order", "SELECT value, n, upto, dense, next_value FROM (SELECT l_quantity AS value, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY l_quantity) AS BIGINT) AS upto, row_number() OVER (ORDER BY l_quantity) AS dense, lead(l_quantity) OVER (ORDER BY l_quantity) AS next_value FROM lineitem GROUP BY l_quantity)")
def w12(spark, sf):
    return ranked_values(table(spark, sf, "lineitem"), "l_quantity").orderBy("value")


# -- feature selection and reduction ------------------------------------------

PRUNE = ["o_totalprice", "c_acctbal", "n_lines", "qty_sum", "price_sum", "disc_avg", "tax_avg", "span_days"]


# the stronger pair is settled first; the column of lower priority goes, never the target
PRUNED = (
    "WITH RECURSIVE " + FULL + ", names AS (SELECT unnest(" + str(PRUNE) + ") AS feature, unnest(range(1, " + str(len(PRUNE) + 1) + ")) AS place), "
    "u AS (" + union(f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS r FROM fullp" for i, a in enumerate(PRUNE) for b in PRUNE[i + 1:]) + "), "
    "s AS MATERIALIZED (SELECT a, b, r, row_number() OVER (ORDER BY round(r, 9) DESC, x.place, y.place) AS i, "
    "CASE WHEN b = 'o_totalprice' THEN a WHEN a = 'o_totalprice' THEN b WHEN b = 'price_sum' THEN a ELSE b END AS worse "
    "FROM u JOIN names x ON x.feature = a JOIN names y ON y.feature = b WHERE r > 0.85), "
    "g(i, lost) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) UNION ALL SELECT s.i, CASE WHEN list_contains(lost, a) OR list_contains(lost, b) THEN lost ELSE list_append(lost, worse) END FROM g JOIN s ON s.i = g.i + 1), "
    "final AS (SELECT lost FROM g ORDER BY i DESC LIMIT 1) "
)


def pruned(df):
    return S.prune_correlated(df, PRUNE, 0.85, ["o_totalprice", "price_sum"], "o_totalprice")


@query("f1_prune_correlated", PRUNED + "SELECT count(*) AS strong_pairs, " + r6("max(r)") + f" AS strongest, {len(PRUNE)} - (SELECT len(lost) FROM final) AS kept FROM s")
def f1(spark, sf):
    df = cut_lineage(full_profile(spark, sf))
    pairs = R.pair_correlations(df, PRUNE)
    strong = spark.createDataFrame(pairs, "a string, b string, r double").where("abs(r) > 0.85")
    kept = [c for c in pruned(df)[0].columns if c in PRUNE]
    return rounded(strong.agg(
        F.count(F.lit(1)).alias("strong_pairs"), F.max(F.abs("r")).alias("strongest"), F.lit(len(kept)).cast("long").alias("kept")), ["strongest"])


@query("f1_kept_columns", PRUNED + "SELECT feature, list_contains(lost, feature) AS dropped FROM names, final")
def f1b(spark, sf):
    lost = pruned(full_profile(spark, sf))[1]
    return spark.createDataFrame([(c, c in lost) for c in PRUNE], "feature string, dropped boolean")


def _mi_sql(features):
    """Brute force over all pairs of the customer table."""
    pts = union(f"SELECT '{f}' AS feature, row_id AS id, {y} AS y, CAST(round({f} * 1000000) AS BIGINT) AS x FROM cust" for f, y in ((f, "c_mktsegment") for f in features))
    psi = "(ln({0} + 8.0) - 0.5 / ({0} + 8.0) - 1 / (12 * ({0} + 8.0) ** 2) + 1 / (120 * ({0} + 8.0) ** 4) - 1 / (252 * ({0} + 8.0) ** 6) - " + " - ".join(f"1 / ({{0}} + {i}.0)" for i in range(8)) + ")"
    return (
        f"WITH {CUSTOMERS}, p AS ({pts}), c AS (SELECT feature, y, count(*) AS ny FROM p GROUP BY 1, 2), "
        "q AS (SELECT p.*, ny, least(5, ny - 1) AS k FROM p JOIN c USING (feature, y) WHERE ny > 1), "
        "nn AS (SELECT a.feature, a.id, any_value(a.x) AS x, any_value(a.ny) AS ny, any_value(a.k) AS k, list_sort(list(abs(a.x - b.x)))[any_value(a.k)] AS d "
        "FROM q a JOIN q b ON a.feature = b.feature AND a.y = b.y AND a.id <> b.id GROUP BY a.feature, a.id), "
        "m AS (SELECT nn.feature, nn.id, any_value(nn.ny) AS ny, any_value(nn.k) AS k, count(*) AS m FROM nn JOIN q ON q.feature = nn.feature AND "
        "(CASE WHEN nn.d > 0 THEN abs(q.x - nn.x) < nn.d ELSE q.x = nn.x END) GROUP BY nn.feature, nn.id) "
        f"SELECT feature, {r6('greatest(0.0, ' + psi.format('count(*)') + ' + avg(' + psi.format('k') + ') - avg(' + psi.format('ny') + ') - avg(' + psi.format('m') + '))')} AS mi FROM m GROUP BY feature"
    )


@query("f2_mutual_info_knn", _mi_sql(["x", "y", "n_orders", "c_nationkey"]))
def f2(spark, sf):
    df = customer_points(spark, sf)
    return rounded(S.mutual_info_knn(df, ["x", "y", "n_orders", "c_nationkey"], "c_mktsegment", 5), ["mi"])


def _mib(f):
    q = ", ".join(f"quantile_cont({f}, {i / 10}) AS e{i}" for i in range(11))
    b = "CASE " + " ".join(f"WHEN {f} <= e{i} THEN {i}" for i in range(1, 11)) + " END"
    return (
        f"SELECT '{f}' AS feature, {r6('sum(n / t * ln(n * t / (nb * ny)))')} AS mi FROM (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY y) AS ny "
        f"FROM (SELECT {b} AS b, o_orderpriority AS y, CAST(count(*) AS DOUBLE) AS n FROM fullp, (SELECT {q} FROM fullp) GROUP BY 1, 2))"
    )


@query("f3_mutual_info_binned", "WITH " + FULL + union(_mib(f) for f in ("o_totalprice", "price_sum", "c_acctbal")))
def f3(spark, sf):
    df = cut_lineage(full_profile(spark, sf))
    return rounded(S.mutual_info_binned(df, ["o_totalprice", "price_sum", "c_acctbal"], "o_orderpriority"), ["mi"])


@query("f4_hybrid_subset")
def f4(spark, sf):
    df = cut_lineage(full_profile(spark, sf))
    mi = S.mutual_info_binned(df, PRUNE, "o_orderpriority")
    corr = {(a, b): r for a, b, r in R.pair_correlations(df, PRUNE)}
    chosen = S.hybrid_subset(["o_totalprice", "price_sum"], [r["feature"] for r in mi.collect()], corr, 6, 0.7)
    return spark.createDataFrame(list(enumerate(chosen, 1)), "position int, feature string")


@query("f5_pca_two_features", "WITH " + FULL + ", m AS (SELECT var_samp(qty_sum) AS a, covar_samp(qty_sum, span_days) AS b, var_samp(span_days) AS d FROM fullp), e AS (SELECT a + d AS tr, sqrt((a + d) ** 2 - 4 * (a * d - b * b)) AS s FROM m) SELECT 1 AS component, " + r6("(tr + s) / (2 * tr)") + " AS ratio FROM e UNION ALL SELECT 2, " + r6("(tr - s) / (2 * tr)") + " FROM e")
def f5(spark, sf):
    df = full_profile(spark, sf)
    return rounded(D.variance_ratios(df, D.pca_fit(df, ["qty_sum", "span_days"])), ["ratio"])


@query("f5_pca_scores")
def f5b(spark, sf):
    df = C.standardize(cut_lineage(full_profile(spark, sf)), NUMERIC)
    return D.pca_reduce(df, NUMERIC, 0.90)[0]


@query("f6_pca_loadings")
def f6(spark, sf):
    df = C.standardize(cut_lineage(full_profile(spark, sf)), NUMERIC)
    fit = D.pca_fit(df, NUMERIC)
    return D.pca_loadings(df, fit, fit.count_for(0.90), 3)


@query("f7_project_2d")
def f7(spark, sf):
    return D.project_2d(C.standardize(cut_lineage(full_profile(spark, sf)), NUMERIC), NUMERIC)


STUDY = MiningConfig(
    label="o_orderstatus", target="priority", percent_columns=("disc_text",), term_column="lines_text",
    years_column="years", years_map={}, id_columns=("n_name",), leakage_columns=("tax_avg",), leakage_prefixes=("settle",),
    group_impute=("span_days", "c_mktsegment"), grade_columns={"priority": {str(i): i for i in range(1, 6)}},
    ordinal_text=(), binary_text={}, nominals=("c_mktsegment",), dropped_nominals=("c_mktsegment",),
    quantile_bins={"o_totalprice": ("Low", "Medium", "High", "Very High"), "c_acctbal": ("Low", "Medium", "High", "Very High")},
    ordinal_columns=("priority", "lines_text"), protected=("priority",), priority=("priority", "o_totalprice", "price_sum"),
    core=("priority", "o_totalprice", "c_acctbal"), n_features=6,
)


def raw_orders(spark, sf):
    """Order profile in the raw form that cleaning repairs: text percents, text terms, a constant."""
    return order_profile(spark, sf).select(
        "row_id", "o_totalprice", "c_acctbal", "qty_sum", "price_sum", "tax_avg", "span_days", "mths_since_return",
        *EVENT_COLUMNS, "c_mktsegment", "n_name", "o_orderstatus",
        F.concat((F.col("disc_avg") * 100).cast("string"), F.lit("%")).alias("disc_text"),
        F.concat(F.lit(" "), F.col("n_lines").cast("int").cast("string"), F.lit(" months")).alias("lines_text"),
        F.substring("o_orderpriority", 1, 1).alias("priority"), F.lit(1).alias("policy"),
    )


@query("f8_prepare_features")
def f8(spark, sf):
    return prepare(cut_lineage(raw_orders(spark, sf)), STUDY)["scaled"]


# -- scalar surface -----------------------------------------------------------


@query("x1_strings", "SELECT p_partkey, replace(p_brand, 'Brand#', 'B') AS b, trim(concat(' ', p_name, ' ')) AS t, split_part(p_name, ' ', 1) AS first, CAST(starts_with(p_name, 'red') AS INTEGER) AS red, CAST(ends_with(p_name, 'widget') AS INTEGER) AS widget, lower(p_type) AS low, substr(p_type, 1, 3) AS cut FROM part")
def x1(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("b"), F.trim(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("t"),
        F.split("p_name", " ")[0].alias("first"), F.col("p_name").startswith("red").cast("int").alias("red"),
        F.col("p_name").endswith("widget").cast("int").alias("widget"), F.lower("p_type").alias("low"), F.substring("p_type", 1, 3).alias("cut"),
    )


@query("x2_math", "SELECT c_custkey, " + r6("abs(c_acctbal)") + " AS a, " + r6("ln(1 + abs(c_acctbal))") + " AS l, " + r6("sqrt(abs(c_acctbal))") + " AS s, least(greatest(c_acctbal, 0.0), 5000.0) AS c FROM customer")
def x2(spark, sf):
    x = F.col("c_acctbal")
    df = table(spark, sf, "customer").select("c_custkey", F.abs(x).alias("a"), F.log1p(F.abs(x)).alias("l"), F.sqrt(F.abs(x)).alias("s"), F.least(F.greatest(x, F.lit(0.0)), F.lit(5000.0)).alias("c"))
    return rounded(df, ["a", "l", "s"])


@query("x3_collections", "SELECT item, count(*) AS n FROM (SELECT unnest(list_sort(list_distinct(string_split(p_name, ' ')))) AS item FROM part) GROUP BY item")
def x3(spark, sf):
    items = table(spark, sf, "part").select(F.explode(F.array_sort(F.array_distinct(F.split("p_name", " ")))).alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


@query("x4_conditionals", WITH + "SELECT row_id, CASE WHEN ev_n IS NULL THEN 'none' WHEN ev_n > 8 THEN 'many' ELSE 'some' END AS activity, coalesce(ev_max, -1.0) AS top, CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END AS bad FROM profile")
def x4(spark, sf):
    return order_profile(spark, sf).select(
        "row_id", F.when(F.col("ev_n").isNull(), "none").when(F.col("ev_n") > 8, "many").otherwise("some").alias("activity"),
        F.coalesce("ev_max", F.lit(-1.0)).alias("top"), F.col("o_orderstatus").isin("F", "P").cast("int").alias("bad"),
    )


@query("x6_dominant_shares", "WITH " + EVENTS + union(f"SELECT '{c}' AS feature, {r6('max(n) * 1.0 / sum(n)')} AS share FROM (SELECT {c}, count(*) AS n FROM evv GROUP BY {c})" for c in ("spike", "one")))
def x6(spark, sf):
    shares = C.dominant_shares(event_values(spark, sf), ["spike", "one"])
    return rounded(spark.createDataFrame(list(shares.items()), "feature string, share double"), ["share"])


