"""The registered query of each operator: whole tables, production parameters, contract columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, embedding_dedup, langid, lexical_search, line_dedup, periodic_runs, pii, quality, sentencepiece_bpe, simhash, token_counts, toxicity
from .common import LOWER, UPPER, fold, hex_digest, model_path, table, written

CONVERSATION = "<|im_end|><|im_start|>assistant ok"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        hex_digest(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_bpe.encode_decode(table(spark, sf_dir, "documents"), model_path("piece_bpe_32k.model"))
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
        hex_digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_digest(F.col("decoded")).alias("decoded_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is spark.shelfwise.pii.key of the session; the fallback is for trials."""
    key = spark.conf.get("spark.shelfwise.pii.key", "shelfwise-trial-key")
    found = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    def count(kind: str):
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), "text")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = model_path("byte_bpe_50k.tiktoken")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", CONVERSATION), (-1, 1, "assistant", CONVERSATION)], given.schema)
    return chat.digests(chat.format_turns(given.union(added), vocabulary), vocabulary).withColumnRenamed("conv", "conv_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), model_path("byte_bpe_50k.tiktoken")).withColumnRenamed("id", "doc_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learnt = langid.dictionaries(docs.where(fold("doc_id") % 3 != 1))
    held_out = F.coalesce(fold("id") % 3 == 1, F.lit(False)).alias("held_out")
    return langid.predict(docs, learnt).select(F.col("id").alias("doc_id"), held_out, "lang_pred", "score", "accepted")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold("id") % 5 == 0, F.lit(False)).alias("held_out")
    return found.select(F.col("id").alias("doc_id"), held_out, "score", "predicted")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", line_dedup.host(F.col("url")).alias("host"), line_dedup.html_text(F.col("html")).alias("text"))
    # Lines are counted and dropped in two passes; the markup is taken out once.
    return line_dedup.drop_boilerplate(written(pages, "page-texts"), "host", "text").select(
        "page_id", "host", "n_lines", "n_dropped", "text")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def _repeated(docs: DataFrame) -> DataFrame:
    """Every tenth document by its id's checksum repeats a part of its words up to its end."""
    h = fold("doc_id")
    g, n = F.expr("crc32(cast(doc_id as string)) div 10"), F.greatest(F.size("w"), F.lit(1))
    a = (g % n).cast("int")
    period = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", a + 1, period), F.ceil((n - a) / period).cast("int"))), F.lit(1), n - a)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(periodic_runs.WORD), F.lit(0))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"))
    joined = F.array_join(F.concat(F.slice("w", F.lit(1), a), tail), " ")
    return chosen.select("doc_id", F.when(F.size("w") > 0, joined).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_repeated(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # Runs come by start and period, so the first of equal quotients stays.
    best = F.reduce("runs", none, lambda x, r: F.when(
        x.isNull() | (r["length"] * x["period"] > x["length"] * r["period"]), r).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[f].cast("string") for f in ("start", "length", "period"))), F.lit("\n")))
    return found.select("*", best.alias("best")).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        hex_digest(F.array_join(lines, "")).alias("runs_sha256"), hex_digest(F.col("collapsed")).alias("collapsed_sha256"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality.score(docs, quality.train(docs, labels.where(fold("doc_id") % 4 != 2)))
    held_out = F.coalesce(fold("id") % 4 == 2, F.lit(False)).alias("held_out")
    return found.select(F.col("id").alias("doc_id"), held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_pii": op3_pii,
    "op4_chat": op4_chat,
    "op5_token_counts": op5_token_counts,
    "op6_language": op6_language,
    "op7_toxicity": op7_toxicity,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_simhash": op10_simhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_quality": op13_quality,
}

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP1 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
spans AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS t(s)),
met AS (SELECT r, s, spans.n, item_id FROM spans JOIN windows USING (win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM met, unnest(range(s, s + n)) AS t(p) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM met) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

_BLOCKS = "p|div|li|ul|ol|nav|article|section|header|footer|aside|main|h[1-6]|table|tr|td|th|title|body|head|html|blockquote|pre|form"
_OP9 = rf"""
WITH bare AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>', ' ', 'g'),
      '(?i)<br\s*/?>|</?(?:{_BLOCKS})\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t
  FROM pages),
placed AS (
  SELECT row_number() OVER () AS r, page_id, host, string_split(replace(replace(replace(replace(replace(replace(
    t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), chr(10)) AS lines FROM bare),
lined AS (SELECT r, host, k, lines[k] AS line, regexp_replace(lines[k], '^[ \t\r]+|[ \t\r]+$', '', 'g') AS key
  FROM placed, unnest(range(1, len(lines) + 1)) AS u(k)),
totals AS (SELECT host, count(*) AS site_pages FROM placed WHERE host IS NOT NULL GROUP BY host HAVING count(*) >= 10),
dropped AS (SELECT host, key FROM lined JOIN totals USING (host) WHERE key <> ''
  GROUP BY host, key, site_pages HAVING count(DISTINCT r) >= 5 AND count(DISTINCT r) > 0.05 * site_pages),
marked AS (SELECT r, k, line, dropped.key IS NOT NULL AS gone FROM lined LEFT JOIN dropped ON lined.host = dropped.host AND lined.key = dropped.key),
cleaned AS (SELECT r, count(*) AS n_lines, count_if(gone) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS text FROM marked GROUP BY r)
SELECT page_id, host, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, text
FROM placed LEFT JOIN cleaned USING (r)
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP11 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark),
corpus AS (SELECT count_if(len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs),
damped AS (SELECT r, doc_id, 25 + (75 * len(w) * n_docs) // greatest(n_terms, 1) AS m FROM docs, corpus),
found AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
asked AS (SELECT q, item_id, t, count(*) AS often FROM (SELECT q, item_id, unnest(w) AS t FROM items) GROUP BY q, item_id, t),
weights AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM found, corpus GROUP BY t, n_docs),
scored AS (SELECT q, item_id, r, doc_id, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN found USING (t) JOIN damped USING (r) GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op1_decontamination": _OP1, "op9_line_dedup": _OP9, "op11_lexical_search": _OP11}
