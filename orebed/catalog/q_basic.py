"""Sources, sinks, columns, nulls and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orebed.catalog.registry import query, r6, rounded
from orebed.catalog.views import (
    EVENT_COLUMNS, EVENTS, NOMINAL, NUMERIC, PROFILE, event_values, order_profile, table,
)
from orebed.operators import align as J
from orebed.operators import columns as C
from orebed.operators import nulls as N
from orebed.operators import sampling as W
from orebed.session import cut_lineage, shared_dir
from orebed.sources import readers, sinks

WITH = "WITH " + PROFILE
ALL_COLUMNS = [*NUMERIC, "mths_since_return", *EVENT_COLUMNS, *NOMINAL]


def scratch(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def profile(spark, sf):
    return cut_lineage(order_profile(spark, sf))


# -- sources and sinks ---------------------------------------------------------


def _as_csv(spark, sf, name):
    path = scratch(spark, name)
    table(spark, sf, name).write.option("header", True).csv(path)
    return path


@query("s1_read_csv", "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1(spark, sf):
    df = readers.read_table(spark, _as_csv(spark, sf, "customer"), "csv")
    return df.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("bigint"), "c_acctbal", "c_mktsegment")


@query("s2_first_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def s2(spark, sf):
    df = readers.read_table(spark, f"{sf}/orders.parquet", nrows=1000, order_by="o_orderkey")
    return df.select("o_orderkey", "o_custkey", "o_totalprice")


@query("s3_sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat_ws('_', o_orderkey, 42)) LIMIT 8900")
def s3(spark, sf):
    return W.sample_exact(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 8900, 42, "o_orderkey")


def _narrow_sql():
    whole = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    parts = [
        f"SELECT '{c}' AS feature, CASE WHEN min({c}) >= -128 AND max({c}) < 128 THEN 'tinyint' "
        f"WHEN min({c}) >= -32768 AND max({c}) < 32768 THEN 'smallint' "
        f"WHEN min({c}) >= -2147483648 AND max({c}) < 2147483648 THEN 'int' ELSE 'bigint' END AS dtype, "
        f"CAST(sum({c}) AS DOUBLE) AS total FROM lineitem" for c in whole
    ]
    parts += [
        f"SELECT '{c}', 'float', round(CAST(sum(CAST({c} AS FLOAT)::DOUBLE) AS DOUBLE), 2) FROM lineitem"
        for c in ("l_quantity", "l_discount")
    ]
    return " UNION ALL ".join(parts)


@query("s4_narrow_types", _narrow_sql())
def s4(spark, sf):
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount"]
    df = readers.narrow_types(table(spark, sf, "lineitem").select(*cols))
    sums = df.agg(*[F.round(F.sum(F.col(c).cast("double")), 2).alias(c) for c in cols]).unpivot([], cols, "feature", "total")
    types = spark.createDataFrame(df.dtypes, "feature string, dtype string")
    return types.join(sums, "feature")


@query("s5_all_text", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer")
def s5(spark, sf):
    return readers.read_table(spark, _as_csv(spark, sf, "customer"), "csv", all_string=True)


@query("s6_save_outputs", "SELECT 'customers' AS artifact, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer UNION ALL SELECT 'orders', count(*), round(sum(o_totalprice), 2) FROM orders")
def s6(spark, sf):
    tables = {
        "customers": table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("v")),
        "orders": table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("v")),
    }
    paths = sinks.save_outputs(tables, scratch(spark, "artifacts"), "csv")
    back = [
        readers.read_table(spark, p, "csv", "k bigint, v double").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 2).alias("total")
        ).select(F.lit(name).alias("artifact"), "n", "total")
        for name, p in paths.items()
    ]
    return W.union_samples(back)


@query("s7_write_labels", "SELECT o_orderkey AS row_id, CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 0 END AS label, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_noise FROM orders")
def s7(spark, sf):
    labels = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.when(F.col("o_orderstatus") == "P", -1).otherwise(0).alias("label")
    )
    path = scratch(spark, "labels")
    sinks.write_labels(labels, path, "label", noise=-1)
    return spark.read.parquet(path)


@query("s8_write_result", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def s8(spark, sf):
    path = scratch(spark, "result")
    df = table(spark, sf, "orders").where("o_totalprice > 300000").select("o_orderkey", "o_totalprice")
    sinks.write_result(df, path, [F.desc("o_totalprice"), "o_orderkey"])
    return spark.read.parquet(path)


@query("s9_read_optional", "SELECT 'supplier' AS source, 1 AS is_real, count(*) AS n FROM supplier UNION ALL SELECT 'absent', 0, count(*) FROM customer")
def s9(spark, sf):
    rows = []
    for name in ("supplier", "absent"):
        df, real = readers.read_optional(spark, f"{sf}/{name}.parquet", lambda: table(spark, sf, "customer"))
        rows.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), F.lit(int(real)).alias("is_real"), "n"))
    return W.union_samples(rows)


# -- casts, encodings, filters ------------------------------------------------


@query("p1_parse_percent", "SELECT o_orderkey, TRY_CAST(trim(replace(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE concat(' ', o_totalprice, '%') END, '%', '')) AS DOUBLE) AS rate FROM orders")
def p1(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE concat(' ', o_totalprice, '%') END AS rate"))
    return C.parse_percent(df, ["rate"])


@query("p2_parse_term", "SELECT p_partkey, TRY_CAST(trim(replace(CASE WHEN p_type = 'ECONOMY' THEN 'unknown' ELSE concat(' ', p_size, ' months') END, 'months', '')) AS BIGINT) AS term FROM part")
def p2(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.expr("CASE WHEN p_type = 'ECONOMY' THEN 'unknown' ELSE concat(' ', p_size, ' months') END AS term"))
    return C.parse_term(df, "term")


STEPS = {"view": 0, "click": 1, "signup": 2, "purchase": 3}


@query("p3_map_values", "SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 END AS step FROM events")
def p3(spark, sf):
    return C.map_values(table(spark, sf, "events"), "event_type", STEPS, "step").select("event_id", "step")


@query("p4_grade_map", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS grade, concat('Grade ', chr(64 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER))) AS label FROM orders")
def p4(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("digit"))
    df = C.map_values(df, "digit", {str(i): i for i in range(1, 6)}, "grade")
    return C.map_values(df, "grade", {i: f"Grade {'ABCDE'[i - 1]}" for i in range(1, 6)}, "label").drop("digit")


@query("p5_ordinal_encode", "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) AS BIGINT) AS brand_rank FROM part")
def p5(spark, sf):
    return C.ordinal_encode(table(spark, sf, "part"), "p_brand", "brand_rank").select("p_partkey", "brand_rank")


@query("p6_binary_encode", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_f FROM orders")
def p6(spark, sf):
    return C.binary_encode(table(spark, sf, "orders"), "o_orderstatus", "F", "is_f").select("o_orderkey", F.col("is_f").cast("int").alias("is_f"))


@query("p7_contains_flag", "SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'HIGH') THEN 1 ELSE 0 END AS is_high FROM orders")
def p7(spark, sf):
    return C.contains_flag(table(spark, sf, "orders"), "o_orderpriority", "HIGH", "is_high").select("o_orderkey", F.col("is_high").cast("int").alias("is_high"))


@query("p8_flag_and_fill", WITH + "SELECT row_id, CASE WHEN mths_since_return IS NULL THEN 0 ELSE 1 END AS mths_since_return_present, coalesce(mths_since_return, 999.0) AS mths_since_return FROM profile")
def p8(spark, sf):
    df = C.flag_and_fill(order_profile(spark, sf), ["mths_since_return"], 999)
    return df.select("row_id", F.col("mths_since_return_present").cast("int").alias("mths_since_return_present"), "mths_since_return")


@query("p9_drop_by_rule", WITH + "SELECT row_id, c_acctbal, n_lines, qty_sum, price_sum, span_days, mths_since_return, c_mktsegment FROM profile")
def p9(spark, sf):
    return C.drop_by_rule(order_profile(spark, sf), names=["o_totalprice"], prefixes=["ev_", "o_order"], contains=["name"], suffixes=["_avg"])


@query("p10_drop_constant", "WITH " + EVENTS + "SELECT row_id, user_id, event_type, value, heavy, spike FROM evv")
def p10(spark, sf):
    return C.drop_constant(event_values(spark, sf).drop("pct_text"))


@query("p11_drop_high_missing", WITH + "SELECT row_id, o_totalprice, n_lines, mths_since_return, c_mktsegment FROM profile")
def p11(spark, sf):
    df = profile(spark, sf).select("row_id", "o_totalprice", "n_lines", "mths_since_return", *EVENT_COLUMNS, "c_mktsegment")
    return C.drop_high_missing(df, 40.0)


def _quasi_sql():
    cols = ["user_id", "event_type", "value", "spike", "one"]
    parts = [
        f"SELECT '{c}' AS feature, max(n) * 1.0 / sum(n) AS share FROM (SELECT {c} AS v, count(*) AS n FROM evv GROUP BY {c})"
        for c in cols
    ]
    return f"WITH {EVENTS}, shares AS ({' UNION ALL '.join(parts)}) SELECT feature FROM shares WHERE share < 0.99"


@query("p12_drop_quasi_constant", _quasi_sql())
def p12(spark, sf):
    df = event_values(spark, sf).select("user_id", "event_type", "value", "spike", "one")
    kept = C.drop_quasi_constant(df, 0.99)
    return spark.createDataFrame([(c,) for c in kept.columns], "feature string")


@query("p13_select_by_type", WITH + "SELECT row_id, " + ", ".join([*NUMERIC, "mths_since_return", *EVENT_COLUMNS]) + " FROM profile")
def p13(spark, sf):
    df = order_profile(spark, sf)
    return df.select(*C.select_by_type(df, "numeric"))


@query("p14_split_nominal", WITH + "SELECT row_id, o_orderpriority, c_mktsegment, n_name FROM profile")
def p14(spark, sf):
    return C.split_nominal(order_profile(spark, sf), ["o_orderpriority", "c_mktsegment", "n_name", "absent"])[1]


def _qcut(c, labels):
    q = len(labels)
    whens = " ".join(f"WHEN {c} <= {c}_{i + 1} THEN '{x}'" for i, x in enumerate(labels))
    return f"CASE {whens} END AS {c}_bin", ", ".join(f"quantile_cont({c}, {i / q}) AS {c}_{i}" for i in range(1, q + 1))


FOUR = ("Low", "Medium", "High", "Very High")
FIVE = ("Very Low", "Low", "Medium", "High", "Very High")


@query("p15_quantile_bin", WITH + f", e AS (SELECT {_qcut('o_totalprice', FOUR)[1]}, {_qcut('qty_sum', FIVE)[1]} FROM profile) SELECT row_id, {_qcut('o_totalprice', FOUR)[0]}, {_qcut('qty_sum', FIVE)[0]} FROM profile, e")
def p15(spark, sf):
    df = profile(spark, sf)
    return C.quantile_bin(df, {"o_totalprice": FOUR, "qty_sum": FIVE}).select("row_id", "o_totalprice_bin", "qty_sum_bin")


@query("p16_cut_bin", "SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'neg' WHEN c_acctbal <= 2500 THEN 'low' WHEN c_acctbal <= 5000 THEN 'mid' WHEN c_acctbal <= 7500 THEN 'high' END AS band FROM customer")
def p16(spark, sf):
    df = C.cut_bin(table(spark, sf, "customer"), "c_acctbal", [float("-inf"), 0, 2500, 5000, 7500], ["neg", "low", "mid", "high"], "band")
    return df.select("c_custkey", "band")


@query("p17_prefix_label", WITH + "SELECT row_id, CASE WHEN ev_n IS NULL THEN NULL ELSE concat('Events ', CAST(CAST(ev_n AS BIGINT) AS VARCHAR)) END AS label FROM profile")
def p17(spark, sf):
    df = order_profile(spark, sf).withColumn("label", F.col("ev_n").cast("bigint"))
    return C.prefix_label(df, "label", "Events ").select("row_id", "label")


def _winsor_sql(c):
    return (
        f"CASE WHEN abs({c}_s) > 1 AND {c}_hi > {c}_m THEN least(greatest({c}, {c}_lo), {c}_hi) ELSE {c} END",
        f"skewness({c}) AS {c}_s, quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.99) AS {c}_hi",
    )


HEAVY = ["value", "heavy", "spike"]


@query("p18_winsorize", "WITH " + EVENTS + ", q AS (SELECT " + ", ".join(_winsor_sql(c)[1] for c in HEAVY) + " FROM evv) SELECT row_id, " + ", ".join(f"{r6(_winsor_sql(c)[0])} AS {c}" for c in HEAVY) + " FROM evv, q")
def p18(spark, sf):
    df = event_values(spark, sf).select("row_id", *HEAVY)
    return rounded(C.winsorize(df, HEAVY)[0], HEAVY)


@query("p19_log_if_better", "WITH " + EVENTS + ", q AS (SELECT " + ", ".join(f"skewness({c}) AS {c}_s, skewness(ln(1 + {c})) AS {c}_l, min({c}) AS {c}_min" for c in HEAVY) + " FROM evv) SELECT row_id, " + ", ".join(r6(f"CASE WHEN abs({c}_s) > 1 AND {c}_min >= 0 AND abs({c}_l) < abs({c}_s) THEN ln(1 + {c}) ELSE {c} END") + f" AS {c}" for c in HEAVY) + " FROM evv, q")
def p19(spark, sf):
    df = event_values(spark, sf).select("row_id", *HEAVY)
    return rounded(C.log_if_better(df, HEAVY)[0], HEAVY)


@query("p20_drop_null_rows", WITH + "SELECT row_id, n_lines, mths_since_return FROM profile WHERE n_lines IS NOT NULL AND mths_since_return IS NOT NULL")
def p20(spark, sf):
    return N.drop_null_rows(order_profile(spark, sf).select("row_id", "n_lines", "mths_since_return"))


@query("p21_require_label", WITH + "SELECT row_id, ev_n FROM profile WHERE ev_n IS NOT NULL")
def p21(spark, sf):
    return N.require_label(order_profile(spark, sf), "ev_n").select("row_id", "ev_n")


@query("p22_filters", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 20000 AND 300000 AND o_orderstatus IN ('F', 'P') AND regexp_matches(o_orderpriority, 'HIGH|LOW') AND NOT contains(o_orderpriority, '5')")
def p22(spark, sf):
    df = C.keep_or_all(table(spark, sf, "orders"), "o_orderstatus", "all")
    return df.where(
        F.col("o_totalprice").between(20000, 300000) & F.col("o_orderstatus").isin("F", "P")
        & F.col("o_orderpriority").rlike("HIGH|LOW") & ~F.contains("o_orderpriority", F.lit("5"))
    ).select("o_orderkey", "o_totalprice")


SCALED = ["o_totalprice", "c_acctbal", "qty_sum", "disc_avg"]


@query("p23_standardize", WITH + ", m AS (SELECT " + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in SCALED) + " FROM profile) SELECT row_id, " + ", ".join(f"{r6(f'({c} - {c}_m) / {c}_s')} AS {c}" for c in SCALED) + " FROM profile, m")
def p23(spark, sf):
    df = profile(spark, sf).select("row_id", *SCALED)
    return rounded(C.standardize(df, SCALED), SCALED)


@query("p24_round_columns", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) AS unit, round(l_discount / 3, 4) AS third FROM lineitem")
def p24(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_extendedprice / 7 AS unit", "l_discount / 3 AS third")
    return C.round_columns(df, {"unit": 2, "third": 4})


@query("p25_clip_upper", "SELECT o_orderkey, least(o_totalprice, 250000.0) AS o_totalprice FROM orders")
def p25(spark, sf):
    return C.clip_upper(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 250000)


@query("p26_segment_names", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Prime' WHEN 'F' THEN 'Higher-risk' ELSE NULL END AS segment FROM orders")
def p26(spark, sf):
    return C.map_values(table(spark, sf, "orders"), "o_orderstatus", {"O": "Prime", "F": "Higher-risk"}, "segment").select("o_orderkey", "segment")


# -- nulls and duplicates -----------------------------------------------------


@query("n1_impute_group_mean", WITH + ", g AS (SELECT c_mktsegment AS s, avg(span_days) AS m FROM profile GROUP BY c_mktsegment), f AS (SELECT row_id, coalesce(span_days, m) AS v FROM profile LEFT JOIN g ON s = c_mktsegment), d AS (SELECT median(v) AS md FROM f) SELECT row_id, " + r6("coalesce(v, md)") + " AS span_days FROM f, d")
def n1(spark, sf):
    return rounded(N.impute_group_mean(profile(spark, sf), "span_days", "c_mktsegment").select("row_id", "span_days"), ["span_days"])


FILLED = ["n_lines", "qty_sum", "disc_avg", "mths_since_return"]


@query("n2_impute_median", WITH + ", m AS (SELECT " + ", ".join(f"median({c}) AS {c}_m" for c in FILLED) + " FROM profile) SELECT row_id, " + ", ".join(f"coalesce({c}, {c}_m) AS {c}" for c in FILLED) + " FROM profile, m")
def n2(spark, sf):
    return N.impute_median(profile(spark, sf), FILLED).select("row_id", *FILLED)


@query("n3_impute_mode", WITH + ", t AS (SELECT row_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE c_mktsegment END AS seg FROM profile), m AS (SELECT seg AS v FROM t WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1) SELECT row_id, coalesce(seg, v) AS seg FROM t, m")
def n3(spark, sf):
    df = order_profile(spark, sf).select("row_id", F.when(F.col("o_orderstatus") != "P", F.col("c_mktsegment")).alias("seg"))
    return N.impute_mode(df, ["seg"])


@query("n4_dedup_rows", "SELECT min(event_id) AS row_id, user_id, event_type, CASE WHEN value > 20 THEN NULL ELSE floor(value) END AS v FROM events GROUP BY ALL")
def n4(spark, sf):
    df = table(spark, sf, "events").selectExpr("event_id AS row_id", "user_id", "event_type", "CASE WHEN value > 20 THEN NULL ELSE CAST(floor(value) AS DOUBLE) END AS v")
    return N.dedup_rows(df)


@query("n5_count_nulls", WITH + "SELECT CAST(" + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in ALL_COLUMNS) + " AS BIGINT) AS total_missing FROM profile")
def n5(spark, sf):
    return N.count_nulls(order_profile(spark, sf))


MISSING = "miss AS (SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing_count, round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 2) AS missing_pct FROM profile"
    for c in ALL_COLUMNS
) + ") WHERE missing_count > 0)"
RULES = [(r"^ev_", "OPTIONAL — customers with events"), (r"^mths_since", "STRUCTURAL — never returned"), (r"_sum|_avg", "AGGREGATE — order without lines")]
MECHANISM = "CASE " + " ".join(f"WHEN regexp_matches(lower(feature), '{p}') THEN '{m}'" for p, m in RULES) + " ELSE 'TO REVIEW — other' END"


@query("n6_missing_profile", WITH + f", {MISSING} SELECT * FROM miss")
def n6(spark, sf):
    return N.missing_profile(order_profile(spark, sf))


@query("n7_classify_missing", WITH + f", {MISSING} SELECT *, {MECHANISM} AS mechanism FROM miss")
def n7(spark, sf):
    return N.classify_missing(N.missing_profile(order_profile(spark, sf)), RULES, "TO REVIEW — other")


@query("n8_missing_bands", WITH + f", {MISSING} SELECT CAST({len(ALL_COLUMNS) + 1} - count(*) AS BIGINT) AS complete, count(*) AS with_missing, count(*) FILTER (missing_pct > 50) AS over_50, count(*) FILTER (missing_pct > 20 AND missing_pct <= 50) AS from_20_to_50, count(*) FILTER (missing_pct <= 20) AS up_to_20 FROM miss")
def n8(spark, sf):
    df = order_profile(spark, sf)
    return N.missing_bands(N.missing_profile(df), len(df.columns))


@query("n8_mechanism_counts", WITH + f", {MISSING} SELECT split_part({MECHANISM}, ' —', 1) AS mechanism, count(*) AS n FROM miss GROUP BY 1")
def n8b(spark, sf):
    return N.mechanism_counts(N.classify_missing(N.missing_profile(order_profile(spark, sf)), RULES, "TO REVIEW — other"))


COND = ["mths_since_return", "ev_n", "n_lines"]


@query("n9_conditional_null_rate", WITH + " UNION ALL ".join(f"SELECT '{c}' AS feature, {r6(f'avg(CASE WHEN n_lines > 2 THEN CAST({c} IS NULL AS INTEGER) END) * 100')} AS null_pct_if, {r6(f'avg(CASE WHEN NOT coalesce(n_lines > 2, false) THEN CAST({c} IS NULL AS INTEGER) END) * 100')} AS null_pct_else FROM profile" for c in COND))
def n9(spark, sf):
    return rounded(N.conditional_null_rate(order_profile(spark, sf), COND, F.col("n_lines") > 2), ["null_pct_if", "null_pct_else"])


# -- joins and set operations -------------------------------------------------


@query("j1_align", "SELECT o_orderkey AS row_id, o_totalprice, o_orderstatus FROM orders")
def j1(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "row_id")
    return J.align(o.select("row_id", "o_totalprice"), o.select("row_id", "o_orderstatus"))


@query("j2_take_rows", "SELECT o_orderkey AS row_id, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)")
def j2(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), "o_totalprice")
    ids = table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_orderkey").alias("row_id"))
    return J.take_rows(o, ids)


@query("j3_flag_membership", "SELECT o_orderkey AS row_id, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50) THEN 1 ELSE 0 END AS hit FROM orders")
def j3(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"))
    ids = table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_orderkey").alias("row_id"))
    return J.flag_membership(o, ids, "hit").select("row_id", F.col("hit").cast("int").alias("hit"))


@query("j4_cross_reference", "SELECT count(*) AS members, count(*) FILTER (n >= 1) AS flagged_1, " + r6("avg(CAST(n >= 1 AS INTEGER)) * 100") + " AS flagged_1_pct, count(*) FILTER (n >= 2) AS flagged_2 FROM (SELECT CAST(o_totalprice > 250000 AS INTEGER) + CAST(o_orderstatus = 'F' AS INTEGER) AS n FROM orders WHERE o_orderpriority = '1-URGENT')")
def j4(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "row_id")
    flags = o.selectExpr("row_id", "int(o_totalprice > 250000) + int(o_orderstatus = 'F') AS n_methods")
    return rounded(J.cross_reference(o.where("o_orderpriority = '1-URGENT'"), flags), ["flagged_1_pct"])


@query("j5_lookup_join", "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def j5(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return J.lookup_join(s, n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "s_name", "n_name")


@query("j6_group_to_rows", WITH + "SELECT row_id, " + r6("avg(qty_sum) OVER (PARTITION BY n_name)") + " AS group_mean FROM profile")
def j6(spark, sf):
    df = profile(spark, sf).select("row_id", "n_name", "qty_sum")
    means = df.groupBy("n_name").agg(F.avg("qty_sum").alias("group_mean"))
    return rounded(df.join(means, "n_name").select("row_id", "group_mean"), ["group_mean"])


@query("j7_concat_columns", WITH + "SELECT row_id, CASE WHEN c_acctbal <= 0 THEN 'neg' WHEN c_acctbal <= 5000 THEN 'mid' ELSE 'high' END AS band, c_mktsegment, n_name FROM profile")
def j7(spark, sf):
    df = profile(spark, sf)
    bins = C.cut_bin(df, "c_acctbal", [float("-inf"), 0, 5000, float("inf")], ["neg", "mid", "high"], "band").select("row_id", "band")
    return J.align(bins, C.split_nominal(df, ["c_mktsegment", "n_name"])[1], check=False)


@query("j9_union_samples", "SELECT row_id, o_orderstatus FROM (SELECT o_orderkey AS row_id, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat_ws('_', o_orderkey, 7)), o_orderkey) AS rn FROM orders) WHERE rn <= CASE o_orderstatus WHEN 'F' THEN 300 ELSE 200 END AND o_orderstatus <> 'P'")
def j9(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderstatus")
    return W.union_samples([
        W.sample_exact(o.where("o_orderstatus = 'F'"), 300, 7), W.sample_exact(o.where("o_orderstatus = 'O'"), 200, 7),
    ])


@query("j10_any_flag", "SELECT o_orderkey, CASE WHEN o_totalprice > 400000 OR o_orderstatus = 'F' THEN 1 ELSE 0 END AS hit FROM orders")
def j10(spark, sf):
    df = table(spark, sf, "orders").withColumns({"a": F.col("o_totalprice") > 400000, "b": F.col("o_orderstatus") == "F"})
    return df.select("o_orderkey", C.any_flag(["a", "b"]).cast("int").alias("hit"))
