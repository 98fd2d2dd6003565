"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the failures as
bits beside the measurements. Policies are named sets of rules: applying one,
or asking what a rule changes, is arithmetic on the stored bits and never reads
the texts again. Everything is column expressions; no row leaves the JVM.

Defined results: a null or empty text has no words and fails ``few_words``; null
ids are carried through; repeated rows are judged one by one; an empty table
gives an empty ledger; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import keyed, words

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; the bit is the place in RULES."""

    name: str
    fails: str


#: The order fixes the bits: append new rules, never reorder.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("stuttering", "100 * n_stutter > 20 * n_words"),
    Rule("word_length", "100 * word_chars < 150 * n_words or word_chars > 25 * n_words"),
    Rule("shouting", "100 * n_bangs > 20 * n_words"),
)
BASE = ("few_words", "repeated_windows")
#: Versioned policies: the rules that a document must not fail.
POLICIES = {
    "v1": BASE,
    "v2": tuple(r.name for r in RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutter", "n_bangs")


def policy_mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << k for k, r in enumerate(rules)}
    return sum(bits[n] for n in set(names))


def _repeated_positions(hashes: str) -> Column:
    """Sorted positions of the entries of a hash array that occur more than once."""
    def repeats(x: Column, i: Column) -> Column:
        before, after = F.get("sorted", i - 1)["h"], F.get("sorted", i + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    return F.sort_array(F.transform(F.filter("sorted", repeats), lambda x: x["p"]))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements of every document, in one narrow pass.

    Only documents in which some window occurs twice sort their windows; for the
    rest a hash set decides. Windows are compared by 64-bit hashes.
    """
    text = F.coalesce("text", F.lit(""))
    split = keyed(docs, id_col, text_col).select(
        "doc_id", text.alias("text"), words(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = split.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("!!")).cast("long").alias("n_bangs"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]),
    )
    none = F.array().cast("array<bigint>")
    windows = hashed.select(
        "*", F.when(F.col("n_words") >= WINDOW, window).otherwise(none).alias("windows"),
        F.size(F.filter("hashes", lambda h, i: F.coalesce(h == F.get("hashes", i - 1), F.lit(False))))
        .cast("long").alias("n_stutter"),
    ).drop("hashes")
    ordered = windows.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
    )).drop("windows")
    places = ordered.withColumn("places", F.when(F.col("sorted").isNotNull(), _repeated_positions("sorted")))
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["at"])).alias("n"), p.alias("at")),
    )["n"]
    return places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select("doc_id", *MEASURES)


def ledger(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measurements plus ``fail_bits``: bit k is set where rule k fails."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits + F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(0).cast("long")
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, names: tuple[str, ...], rules: tuple[Rule, ...] = RULES, into: str = "kept") -> DataFrame:
    """``into`` is true where no rule of the policy fails; reads the bits only."""
    return book.withColumn(into, F.col("fail_bits").bitwiseAND(F.lit(policy_mask(names, rules))) == 0)


def ablations(book: DataFrame, names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept without it.

    Documents first collapse to one row per distinct bit pattern in the map
    tasks, so the work behind the first aggregation does not grow with the data.
    """
    mask = policy_mask(names, rules)
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    each = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
        for k, r in enumerate(rules) if r.name in names
    ])
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.select("bits", "n", F.explode(each).alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failing"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
            F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("r.bit")), F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def keep_good(docs: DataFrame, names: tuple[str, ...] = POLICIES["v2"]) -> DataFrame:
    """Rows of ``docs`` that pass the policy, with all their columns.

    The ledger carries each row through as one struct, so it needs no join and
    repeated rows stay separate.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    book = apply_policy(ledger(whole, id_col="row"), names)
    # always true, and not deterministic: keeps the filter above the measurements, which it would repeat
    once = book.select("doc_id", F.when(F.monotonically_increasing_id() >= 0, F.col("kept")).alias("kept"))
    return once.where("kept").select("doc_id.*")
