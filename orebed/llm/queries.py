"""Registered queries of the training-data operators and their SQL checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.llm import (
    capfilters, decontam, htmlmain, lexsearch, linechunks, nearsets, packing, quality, rnsmine, secretscan, sentencepieces, urlfilter, warc)
from orebed.llm.common import table
from orebed.session import shared_dir


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every document under the base rules and the current policy."""
    book = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), quality.POLICIES["v2"])
    base = F.col("fail_bits").bitwiseAND(F.lit(quality.policy_mask(quality.BASE))) != 0
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "fail_bits",
    )


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
cover AS (
  SELECT r, sum(least(8, coalesce(i - p, 8))) AS n
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM again) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter,
         len(regexp_extract_all(text, '!!')) AS n_bangs
  FROM d LEFT JOIN cover USING (r)),
b AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
    + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT
    + 16 * (100 * n_stutter > 20 * n_words)::BIGINT
    + 32 * (100 * word_chars < 150 * n_words OR word_chars > 25 * n_words)::BIGINT
    + 64 * (100 * n_bangs > 20 * n_words)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM b
"""


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of four-word shingle sets."""
    found = nearsets.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)
    return found.select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document without chunks of lines that stand earlier in the corpus."""
    return linechunks.dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "text", "removed_chunks", "removed_lines")


OP3_SQL = f"""
WITH line AS (
  SELECT doc_id, i, l, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) AS w, ('0x' || substr(md5(l), 1, 8))::BIGINT AS h
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i, ls[i] AS l
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
ends AS (
  SELECT *, (coalesce(lag(h) OVER o, 0) * {linechunks.MULTIPLIER} + h) % {linechunks.ONE_IN} = 0
     OR w >= {linechunks.LONG_WORDS} OR coalesce(lead(w) OVER o, 0) >= {linechunks.LONG_WORDS} AS is_end
  FROM line WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
told AS (
  SELECT *, coalesce(sum(is_end::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM ends),
chunk AS (
  SELECT doc_id, c, min(i) AS place, count(*) AS n, string_agg(l, chr(10) ORDER BY i) AS t,
         max(w) >= {linechunks.LONG_WORDS} OR count(*) FILTER (WHERE w > 0) >= 2 AND sum(w) >= {linechunks.LEAST_WORDS} AS eligible
  FROM told GROUP BY doc_id, c),
marked AS (
  SELECT *, eligible AND row_number() OVER (PARTITION BY t, eligible ORDER BY doc_id, place) > 1 AS gone FROM chunk),
left_over AS (
  SELECT doc_id, coalesce(string_agg(t, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text, count(*) FILTER (WHERE gone) AS removed_chunks,
         coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS removed_lines
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, l.text, coalesce(removed_chunks, 0) AS removed_chunks, coalesce(removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN left_over l USING (doc_id)
"""


def op3_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document without passages and chunks of lines that stand earlier in the corpus."""
    return linechunks.dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "text", "removed_lines")


OP3_PASSAGE_SQL = OP3_SQL[: OP3_SQL.index("marked AS (")] + f"""
run AS (SELECT doc_id, i, l, w, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM line),
held AS (
  SELECT a.doc_id, a.i AS s, b.i AS e FROM run a JOIN run b
  ON a.doc_id = b.doc_id AND a.i <= b.i AND b.upto - a.upto + a.w >= {linechunks.LONG_WORDS}),
span AS (
  SELECT doc_id, s, min(e) AS e FROM held GROUP BY doc_id, s
  UNION SELECT doc_id, max(s), e FROM held GROUP BY doc_id, e
  UNION SELECT doc_id, place, place + n - 1 FROM chunk WHERE eligible),
spoken AS (
  SELECT p.doc_id, s, e, string_agg(l, chr(10) ORDER BY i) AS t
  FROM span p JOIN line r ON r.doc_id = p.doc_id AND i BETWEEN s AND e GROUP BY p.doc_id, s, e),
placed AS (
  SELECT *, first_value(doc_id) OVER o AS first_doc, first_value(e) OVER o AS first_end
  FROM spoken WINDOW o AS (PARTITION BY t ORDER BY doc_id, s)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM placed WHERE doc_id <> first_doc OR s > first_end),
left_over AS (
  SELECT line.doc_id, coalesce(string_agg(l, chr(10) ORDER BY line.i) FILTER (WHERE gone.i IS NULL), '') AS text,
         count(gone.i) AS removed_lines
  FROM line LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.i = line.i GROUP BY line.doc_id)
SELECT d.doc_id, l.text, coalesce(removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN left_over l USING (doc_id)
"""


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives in the shared folder and read back."""
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).drop("url")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.98."""
    return capfilters.near_vectors(table(spark, sf_dir, "embeddings"), 0.98).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmlmain.extract(table(spark, sf_dir, "pages"))


URL_RULES = (
    urlfilter.Rule("allow", "org", "/"), urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"), urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page url; the labels of the document that a path names are the evidence."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url",
        F.expr(r"try_cast(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*/(?:[^?#]*?/)?([0-9]+)', 1), '') AS bigint)").alias("label_id"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("label_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urlfilter.judge(pages, URL_RULES, labels).select(
        "page_id", "host", "path", "rule", "verdict", "template", "bad_share")


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: strong spans, and all spans with the linked weak parts."""
    found = secretscan.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(secretscan.KINDS[:3])],
        F.sha2(secretscan.written("base"), 256).alias("base_sha256"), secretscan.written("spans").alias("spans"))


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT html, max(page_id) AS keeper FROM p GROUP BY html),
h AS (SELECT p.page_id, octet_length(encode(p.html)) AS n, sha1(p.html) AS hex, keeper FROM p JOIN k ON p.html = k.html)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ('0b' || substr(array_to_string(list_transform(range(1, 41), lambda j:
           right(bin(('0x' || substr(hex, j, 1))::INT + 16), 4)), ''), 5 * i + 1, 5))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM h
"""


def _spans_sql(kind: str, keep: str, source: str | None = None) -> str:
    """CTE text: spans of one kind as (r, start, k, finish), from the pieces between matches."""
    pattern = secretscan.PATTERNS[source or kind].replace("'", "''")
    k = secretscan.KINDS.index(kind)
    return f"""
  SELECT r, start, {k} AS k, start + size AS finish FROM (
    SELECT r, i, size, value,
           coalesce(sum(gap + size) OVER (PARTITION BY r ORDER BY i) - size, 0) AS start
    FROM (
      SELECT r, i, length(g[i]) AS gap, length(m[i]) AS size, length(v[i]) AS value
      FROM (SELECT r, regexp_split_to_array(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}', 0) AS m,
                   regexp_extract_all(text, '{pattern}', 2) AS v, unnest(range(1, len(m) + 1)) AS i FROM d)))
  WHERE {keep}"""


_KIND_SQL = "CASE k " + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(secretscan.KINDS)) + " END"
OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({" UNION ALL ".join([
    _spans_sql("assign", "value >= 8"), _spans_sql("access", "size >= 16"), _spans_sql("hex", "true")])}),
weak AS ({" UNION ALL ".join([
    _spans_sql("login", "true"), _spans_sql("short", "value BETWEEN 4 AND 7", "assign"), _spans_sql("weak", "true"),
    _spans_sql("bare", "size = 40"), _spans_sql("endpoint", "true")])}),
part AS MATERIALIZED (SELECT * FROM base UNION ALL SELECT * FROM weak),
link AS (
  SELECT s.r, s.start AS s1, s.k AS k1, s.finish AS f1, o.start AS s2, o.k AS k2, o.finish AS f2
  FROM part s JOIN part o ON s.r = o.r AND s.k IN (0, 4, 5, 6) AND o.k IN (1, 3, 7)
   AND o.start - s.finish <= {secretscan.REACH} AND s.start - o.finish <= {secretscan.REACH}),
every AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM (SELECT r, s1, k1, f1 FROM link WHERE k1 >= 3 UNION SELECT r, s2, k2, f2 FROM link WHERE k2 >= 3)),
told AS (SELECT r, string_agg(({_KIND_SQL}) || ':' || start::BIGINT || ':' || finish::BIGINT, ',' ORDER BY start, k, finish) AS s
         FROM every GROUP BY r),
based AS (SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h,
                 string_agg(({_KIND_SQL}) || ':' || start::BIGINT || ':' || finish::BIGINT, ',' ORDER BY start, k, finish) AS s
          FROM base GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(based.s, '')) AS base_sha256, coalesce(told.s, '') AS spans
FROM d LEFT JOIN based USING (r) LEFT JOIN told USING (r)
"""


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepieces.encode(table(spark, sf_dir, "documents"), path)
    return encoded.withColumn("text", sentencepieces.decoded(F.col("ids"), path)).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every token piece of every document."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of ten-word windows of benchmark items."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontam.item_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_NORMAL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH it AS (SELECT item_id, {_NORMAL} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS key
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM it WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_NORMAL} AS w FROM documents),
lens AS (SELECT DISTINCT k FROM win),
dw AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS key
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN lens ON len(w) >= k)),
m AS MATERIALIZED (SELECT dw.r, dw.i, dw.k, win.item_id FROM dw JOIN win ON dw.k = win.k AND dw.key = win.key),
hit AS (
  SELECT r, count(DISTINCT j) AS n_hit
  FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, i, k FROM m)) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS h
  FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three hard negatives per anchor and positive, every 50th vector an anchor."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rnsmine.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0,
                                  positives=5, negatives=3, low=50, high=95)


OP12_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({rnsmine.SCALE} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR NOT abs(x::DOUBLE) < {rnsmine.LIMIT})) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same,
         coalesce(list_sum(list_transform(range(1, least(len(a.e), len(v.e)) + 1), lambda i: a.e[i] * v.e[i])), 0)::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) a JOIN v ON a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS r FROM s WHERE same)
  WHERE r <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents of every benchmark item under integer BM25 weights."""
    return lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL),
dl AS (SELECT doc_id, sum(tf) AS n FROM p GROUP BY doc_id),
g AS (SELECT count(*) AS nd, sum(n) AS l FROM dl),
w AS (SELECT term, floor(1000 * ln((2 * g.nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term, g.nd),
c AS (
  SELECT p.doc_id, p.term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * dl.n * g.nd) // g.l)) AS c
  FROM p JOIN dl USING (doc_id), g),
q AS (SELECT item_id, term, count(*) AS qn FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (
  SELECT q.item_id, c.doc_id, sum(q.qn * w.w * c.c) AS score
  FROM q JOIN w USING (term) JOIN c USING (term) GROUP BY q.item_id, c.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score::BIGINT AS score FROM r WHERE rank <= 10
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op3_passage_dedup": op3_passage_dedup,
    "op4_warc": op4_warc,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_url_filters": op7_url_filters,
    "op8_secret_scans": op8_secret_scans,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_decontamination": op11_decontamination,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}
ORACLES = {
    "op1_quality_rules": OP1_SQL,
    "op3_line_dedup": OP3_SQL,
    "op3_passage_dedup": OP3_PASSAGE_SQL,
    "op4_warc": OP4_SQL,
    "op8_secret_scans": OP8_SQL,
    "op11_decontamination": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
