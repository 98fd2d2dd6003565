"""Frequent itemsets and association rules on baskets of distinct items."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.functions.orderstats import aggregate_row
from orebed.session import cut_lineage, release

BROADCAST_ITEMSETS = 500_000


def to_baskets(df: DataFrame, cols: Sequence[str], key: str = "row_id") -> DataFrame:
    """Row key and the sorted items ``column_value`` of its non-null columns."""
    items = F.array(*[F.concat(F.lit(f"{c}_"), F.col(c).cast("string")) for c in cols])
    return df.select(key, F.array_sort(F.array_compact(items)).alias("items"))


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.04, max_len: int = 4, column: str = "items") -> DataFrame:
    """(items, size, n, support) of all itemsets in at least ``min_support`` of the baskets.

    Equal baskets are merged first, so the levels run over distinct baskets
    with a weight. Each level extends the frequent sets inside a basket by a
    later frequent item and counts the extensions; the sums combine in the map
    tasks. A basket of m items supports at most sum C(m, i) sets, so no more
    than that number divided by ``min_support`` sets can be frequent: this
    bound is checked before a level's sets are broadcast.
    """
    total, widest = aggregate_row(baskets, [F.count(F.lit(1)), F.max(F.size(column))])
    if not total:
        raise ValueError("no baskets")
    least = math.ceil(min_support * total - 1e-9)
    bound = sum(math.comb(widest, i) for i in range(1, max_len + 1)) / min_support
    small = bound <= BROADCAST_ITEMSETS

    def sent(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    weighted = cut_lineage(baskets.groupBy(F.array_distinct(F.array_sort(column)).alias("items")).agg(F.count(F.lit(1)).alias("w")))
    level = (
        weighted.select(F.explode("items").alias("i"), "w").groupBy("i")
        .agg(F.sum("w").alias("n")).where(F.col("n") >= least)
        .select(F.array("i").alias("set"), "n")
    )
    level = cut_lineage(level)
    levels = [level]
    # (basket, one of its frequent sets)
    held = weighted.select("items", "w", F.explode("items").alias("last")).select(
        "items", "w", F.array("last").alias("set")
    )
    frequent_items = level.select(F.element_at("set", 1).alias("last"))
    written = None
    for size in range(2, max_len + 1):
        held = held.join(sent(level.select("set")), "set", "left_semi")
        last = F.element_at("set", -1)
        grown = held.select(
            "items", "w", "set", F.explode(F.filter("items", lambda x: x > last)).alias("last")
        ).join(sent(frequent_items), "last", "left_semi").select(
            "items", "w", F.concat("set", F.array("last")).alias("set")
        )
        # the next level starts from this one's rows instead of growing them again
        grown = cut_lineage(grown) if size < max_len else grown
        level = cut_lineage(
            grown.groupBy("set").agg(F.sum("w").alias("n")).where(F.col("n") >= least)
        )
        release(written)
        levels.append(level)
        held, written = grown, grown if size < max_len else None
        if level.isEmpty():
            break
    release(written, weighted)
    found = levels[0]
    for t in levels[1:]:
        found = found.unionByName(t)
    return found.select(
        F.col("set").alias("items"), F.size("set").alias("size"), "n",
        (F.col("n") / F.lit(float(total))).alias("support"),
    )


def generate_rules(itemsets: DataFrame) -> DataFrame:
    """All rules antecedent -> consequent that split a frequent itemset, with their measures.

    Every non-empty proper subset of an itemset is an antecedent. Supports are
    looked up on the item arrays, since each side is itself frequent.
    """
    size = F.col("size")
    splits = F.transform(
        F.sequence(F.lit(1), (F.pow(F.lit(2), size) - 2).cast("int")),
        lambda m: F.struct(
            F.filter("items", lambda x, i: F.getbit(m, i) == 1).alias("antecedent"),
            F.filter("items", lambda x, i: F.getbit(m, i) == 0).alias("consequent"),
        ),
    )
    halves = itemsets.where(size > 1).select("support", F.explode(splits).alias("r")).select(
        "r.antecedent", "r.consequent", "support"
    )
    known = itemsets.select("items", F.col("support").alias("s"))
    rules = (
        halves
        .join(known.select(F.col("items").alias("antecedent"), F.col("s").alias("sa")), "antecedent")
        .join(known.select(F.col("items").alias("consequent"), F.col("s").alias("sc")), "consequent")
    )
    confidence = F.col("support") / F.col("sa")
    return rules.select(
        "antecedent", "consequent", "support", confidence.alias("confidence"),
        (confidence / F.col("sc")).alias("lift"),
        (F.col("support") - F.col("sa") * F.col("sc")).alias("leverage"),
        F.when(confidence < 1, (1 - F.col("sc")) / (1 - confidence)).alias("conviction"),
    )


def filter_rules(rules: DataFrame, min_lift: float = 1.15, min_confidence: float = 0.5) -> DataFrame:
    """Rules strictly above both thresholds."""
    return rules.where((F.col("lift") > min_lift) & (F.col("confidence") > min_confidence))


def render_rules(rules: DataFrame) -> DataFrame:
    """Sides as sorted text joined by comma and blank."""
    return rules.withColumns({
        "antecedents": F.array_join(F.array_sort("antecedent"), ", "),
        "consequents": F.array_join(F.array_sort("consequent"), ", "),
    }).drop("antecedent", "consequent")


def rule_stats(rules: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: rules before and after the filter, retention and kept lift range."""
    before = rules.count()
    return kept.agg(
        F.lit(before).cast("bigint").alias("n_before"),
        F.count(F.lit(1)).alias("n_after"),
        (F.count(F.lit(1)) / F.lit(float(before or 1)) * 100).alias("retention_pct"),
        F.min("lift").alias("min_lift"), F.max("lift").alias("max_lift"),
    )


def _text(column: str) -> Column:
    return F.array_join(F.array_sort(column), ", ")


def rules_towards(rules: DataFrame, consequent: str, pattern: str) -> DataFrame:
    """Rules whose consequent holds a text and whose antecedent fits a pattern."""
    return rules.where(F.contains(_text("consequent"), F.lit(consequent)) & _text("antecedent").rlike(pattern))


def involving(rules: DataFrame, text: str) -> DataFrame:
    """Rules with an item holding a text on either side."""
    hit = lambda side: F.exists(side, lambda i: F.contains(i, F.lit(text)))
    return rules.where(hit("antecedent") | hit("consequent"))


def drop_structural(rules: DataFrame, a: str, b: str) -> DataFrame:
    """Without the one-to-one rules between items of two attributes that imply each other."""
    def single(side: str, attr: str) -> Column:
        return (F.size(side) == 1) & F.startswith(F.element_at(side, 1), F.lit(f"{attr}_"))

    forth = single("antecedent", a) & single("consequent", b)
    back = single("antecedent", b) & single("consequent", a)
    return rules.where(~(forth | back))


def rules_without(rules: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Rules with no item of the given attributes on either side."""
    prefixes = [f"{a}_" for a in attrs]

    def named(item: Column) -> Column:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | F.startswith(item, F.lit(p))
        return hit

    return rules.where(~F.exists("antecedent", named) & ~F.exists("consequent", named))


def rule_edges(rules: DataFrame, k: int = 12) -> DataFrame:
    """Item pairs of the k rules of highest lift, with a line width from 1 to 5."""
    order = [F.desc("lift"), _text("antecedent"), _text("consequent")]
    top = rules.orderBy(*order).limit(k)
    lo, hi = top.agg(F.min("lift"), F.max("lift")).first()
    width = 1 + 4 * (F.col("lift") - F.lit(lo)) / F.lit(max((hi or 0) - (lo or 0), 1e-9))
    return top.withColumn("width", width).select(
        F.explode("antecedent").alias("source"), "consequent", "lift", "confidence", "width"
    ).select("source", F.explode("consequent").alias("target"), "lift", "confidence", "width")


def short_label(item: Column, prefixes: Sequence[str]) -> Column:
    """Item without its attribute prefix; unknown items with blanks for underscores."""
    out = F.when(F.lit(False), F.lit(""))
    for p in prefixes:
        out = out.when(F.startswith(item, F.lit(f"{p}_")), F.substring(item, len(p) + 2, 10_000))
    return out.otherwise(F.replace(item, F.lit("_"), F.lit(" ")))


def rule_catalogue(rules: DataFrame, category: Column, chosen: str = "all") -> tuple[DataFrame, DataFrame]:
    """Rules of one category (or all) and the number of rules per category."""
    named = rules.withColumn("category", category)
    counts = named.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category")
    return (named if chosen == "all" else named.where(F.col("category") == chosen)), counts
