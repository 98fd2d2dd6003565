"""Secret scans with multipart credential linking.

Strong patterns are reported wherever they match. Weak parts (login names, short
or bare values, endpoints) prove little alone; they are reported only where a
secret and an identifier or endpoint lie within ``REACH`` code points of each
other in one text, found by an interval join on (text, block of positions).
Everything is column expressions and joins; no row leaves the JVM.

Defined results: null and empty texts have no spans; null ids are carried
through; repeated rows each get the spans of their text, worked out once per
distinct text; an empty table gives an empty result; other columns are ignored
or, in ``redact``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import cut

#: Largest gap, in code points, between parts that belong together.
REACH = 200

# The order of kinds and the patterns of their spans. Each pattern
# has a (possibly empty) group 1 and the value in group 2.
KINDS = ("assign", "access", "hex", "login", "short", "weak", "bare", "endpoint")
_TO_VALUE = r"""["']?\x20*[:=]\x20*["']?"""


def any_case(words: str) -> str:
    """A pattern for ``words`` with ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else c for c in words)


PATTERNS = {
    "assign": any_case("(password|passwd|secret|token|api_?key)") + _TO_VALUE + "([A-Za-z0-9+/_.=-]+)",
    "access": "()(AKIA[A-Z0-9]+)",
    "hex": "()([0-9a-f]{32,})",
    "login": any_case("(username|user|login|account|client_?id|key_?id)") + _TO_VALUE + "([A-Za-z0-9@._+-]{3,})",
    "weak": any_case("(passphrase|passcode|pass|pwd|private_?key|secret_?key|access_?key)") + _TO_VALUE
    + r"""([^\x20\x09-\x0D"',;]{4,})""",
    "bare": "()([A-Za-z0-9/+]{40,})",
    "endpoint": r"""()([a-z][a-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+)""",
}
_SPAN = "array<struct<start:int,k:int,end:int>>"


def _matches(text: Column, kind: str) -> Column:
    """array<struct<start, size, value>> of the matches: place, length and length of group 2.

    Matches alternate with the pieces a split leaves, so their places are
    running sums of lengths.
    """
    pattern = F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(2))
    sizes = F.zip_with(
        F.split(text, PATTERNS[kind], -1), F.arrays_zip(whole.alias("w"), value.alias("v")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["w"]).alias("size"), F.length(m["v"]).alias("value")),
    )
    item = "array<struct<start:int,size:int,value:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(item).alias("out"))

    def step(a: Column, x: Column) -> Column:
        here = a["at"] + x["gap"]
        made = F.struct(here.alias("start"), x["size"].alias("size"), x["value"].alias("value"))
        return F.struct((here + x["size"]).alias("at"), F.concat(a["out"], F.array(made)).alias("out"))

    # the piece behind the last match has no partner
    return F.aggregate(F.filter(sizes, lambda x: x["size"].isNotNull()), start, step)["out"]


def _spans(matches: str, kind: str, keep) -> Column:
    k = KINDS.index(kind)
    return F.transform(F.filter(matches, keep), lambda x: F.struct(
        x["start"].alias("start"), F.lit(k).alias("k"), (x["start"] + x["size"]).alias("end")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(doc_id, key, base, parts[, text]): strong spans and weak parts of each text; one narrow pass.

    ``key`` is the digest of the text. Each pattern runs only on texts that hold
    a character that it cannot do without.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    assigns = F.contains("text", F.lit("=")) | F.contains("text", F.lit(":"))
    needs = {
        "assign": assigns, "login": assigns, "weak": assigns, "access": F.contains("text", F.lit("AKIA")),
        "endpoint": F.contains("text", F.lit("://")), "hex": F.col("text").rlike("[0-9a-f]{32}"),
    }
    first = rows.select("*", *[F.when(need, _matches(F.col("text"), kind)).alias(kind) for kind, need in needs.items()])
    others = F.coalesce(F.size("login") > 0, F.lit(False)) | F.coalesce(F.size("access") > 0, F.lit(False)) \
        | F.coalesce(F.size("endpoint") > 0, F.lit(False))
    full = first.withColumn("bare", F.when(others, _matches(F.col("text"), "bare")))
    every = lambda x: x["size"] > 0
    found = {
        "assign": _spans("assign", "assign", lambda x: x["value"] >= 8),
        "access": _spans("access", "access", lambda x: x["size"] >= 16),
        "hex": _spans("hex", "hex", every),
        "login": _spans("login", "login", every),
        "short": _spans("assign", "short", lambda x: (x["value"] >= 4) & (x["value"] < 8)),
        "weak": _spans("weak", "weak", every),
        "bare": _spans("bare", "bare", lambda x: x["size"] == 40),
        "endpoint": _spans("endpoint", "endpoint", every),
    }
    none = F.array().cast(_SPAN)
    joined = lambda kinds: F.sort_array(F.concat(*[F.coalesce(found[k], none) for k in kinds]))
    return full.select(
        "doc_id", F.md5("text").alias("key"), joined(KINDS[:3]).alias("base"), joined(KINDS[3:]).alias("parts"),
        *(["text"] if keep_text else []),
    )


_SECRETS = [KINDS.index(k) for k in ("assign", "short", "weak", "bare")]
_OTHERS = [KINDS.index(k) for k in ("access", "login", "endpoint")]


def _linkable() -> Column:
    """Whether a text holds a secret and an identifier or endpoint, at least one of them weak."""
    both = F.concat("base", "parts")
    has = lambda kinds: F.exists(both, lambda x: x["k"].isin(kinds))
    return (F.size("parts") > 0) & has(_SECRETS) & has(_OTHERS)


def link(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """(key, linked): the weak parts of each text that have a complementary part within reach."""
    texts = scanned.where(_linkable()).groupBy("key").agg(
        F.first("base").alias("base"), F.first("parts").alias("parts"))
    parts = texts.select("key", F.explode(F.concat("base", "parts")).alias("p")).select("key", "p.*")

    def blocks(kinds: list[int], spread: int, names: str) -> DataFrame:
        start, k, end = names.split()
        low = F.floor((F.col("start") - spread) / reach)
        return parts.where(F.col("k").isin(kinds)).select(
            "key", F.col("start").alias(start), F.col("k").alias(k), F.col("end").alias(end),
            F.explode(F.sequence(low, F.floor((F.col("end") + spread) / reach))).alias("block"))

    near = blocks(_SECRETS, 0, "start k end").join(blocks(_OTHERS, reach, "o_start o_k o_end"), ["key", "block"]).where(
        (F.col("o_start") - F.col("end") <= reach) & (F.col("start") - F.col("o_end") <= reach))
    sides = F.array(F.struct("start", "k", "end"), F.struct(
        F.col("o_start").alias("start"), F.col("o_k").alias("k"), F.col("o_end").alias("end")))
    weak = near.select("key", F.explode(sides).alias("p")).where(F.col("p.k") >= 3).distinct()
    return weak.groupBy("key").agg(F.sort_array(F.collect_list("p")).alias("linked"))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, reach: int = REACH
) -> DataFrame:
    """(doc_id, base, spans[, text]) of every row: strong spans, and those with the linked weak parts.

    Only the few texts with complementary parts take part in joins.
    """
    scanned = cut(scan(docs, id_col, text_col, keep_text))
    carried = ["doc_id", "base", *(["text"] if keep_text else [])]
    alone = scanned.where(~_linkable()).select(*carried, F.col("base").alias("spans"))
    linked = scanned.where(_linkable()).join(link(scanned, reach), "key", "left")
    more = F.sort_array(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN))))
    return alone.unionByName(linked.select(*carried, more.alias("spans")))


def written(spans: str) -> Column:
    """``kind:start:end`` of the spans by start and kind, comma-joined."""
    kind = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["start"], x["end"])), ",")


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """Rows of ``docs`` with every span of ``text`` replaced; overlapping spans become one mark.

    ``n_chars``, where there is such a column, follows the new text.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col("text"))
    found = find_secrets(whole, id_col="row")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a: Column, x: Column) -> Column:
        gap = x["start"] - a["at"]
        plain = F.substring(F.col("doc_id.text"), a["at"] + 1, F.greatest(gap, F.lit(0)))
        added = F.when(gap >= 0, F.concat(plain, F.lit(mark))).when(a["at"] == 0, F.lit(mark)).otherwise("")
        return F.struct(F.concat(a["out"], added).alias("out"), F.greatest(a["at"], x["end"]).alias("at"))

    done = F.aggregate("spans", start, step)
    rest = F.substring(F.col("doc_id.text"), done["at"] + 1, F.length("doc_id.text"))
    text = F.when(F.size("spans") == 0, F.col("doc_id.text")).otherwise(F.concat(done["out"], rest))
    clean = found.select("doc_id", text.alias("clean"))
    kept = [F.col("clean").alias("text") if c == "text" else F.length("clean").cast("long").alias(c) if c == "n_chars"
            else F.col("doc_id")[c].alias(c) for c in docs.columns]
    return clean.select(*kept)
