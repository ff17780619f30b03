"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    audit,
    bpe,
    extraction,
    fingerprint,
    language,
    negatives,
    ngram_join,
    packing,
    quality,
    quotation,
    toxicity,
    url_rules,
    warc,
)
from ledgerlake.llm.common import read_table, scratch_path


def fold(n: int) -> Column:
    """CRC-32 of the document id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_vocabulary() -> str:
    """The vocabulary of the token operators."""
    return vocabulary_path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048."""
    return packing.packed(read_table(spark, sf_dir, "documents"), word_vocabulary())


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back as transactions."""
    archives = scratch_path(spark, "archives")
    warc.write_archives(read_table(spark, sf_dir, "pages"), archives)
    return warc.digest_rows(warc.transactions(
        warc.read_records(spark, archives, payloads=False)))


#: Host, path and verdict of the rules that op3 judges by.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the longest fitting rule on every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(read_table(spark, sf_dir, "pages"), rules)


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edit, and their likeness."""
    docs = read_table(spark, sf_dir, "documents")
    ranks = fingerprint.rank_table(fingerprint.level_counts(docs))
    return fingerprint.compare_with_edits(docs, ranks)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; one fold in four is held out of training."""
    docs = read_table(spark, sf_dir, "documents")
    pieces = vocabulary_path("piece_bpe_32k.model")
    model = language.learn(docs, pieces, fold(4) != 2)
    return language.predict(docs, model, pieces, ["doc_id"]).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; the list is learned from ``labels.quality``."""
    docs = read_table(spark, sf_dir, "documents")
    rules = quality.learn_from(docs, read_table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules)


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of ids, digest of the ids and of the decoded text of every document."""
    return bpe.digests(read_table(spark, sf_dir, "documents"), word_vocabulary(), ["doc_id"])


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document: five-word n-grams, similarity 0.8 or more."""
    return ngram_join.join_classes(read_table(spark, sf_dir, "documents"))


def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message's place in reply order, and its text without quotes as a digest."""
    linked = quotation.link_quotations(read_table(spark, sf_dir, "conversations"))
    return linked.select(
        "conv_id", "turn", "role", "reply_to", "root_turn", "reply_depth", "position",
        "quote_level", "n_quoted_lines", "n_linked", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the labels of one fold in five are held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.scored(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three negatives for each of the five positives of every anchor."""
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, label, F.col("vec_id") % 50 == 0)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages")
    return extraction.extracted(pages, extraction.learn(pages))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, by language."""
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_warc": op2_warc,
    "op3_url_filters": op3_url_filters,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_ngram_join": op8_ngram_join,
    "op9_quotation_linking": op9_quotation_linking,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_html_extraction": op12_html_extraction,
    "op13_filter_audit": op13_filter_audit,
}

# Host and path of a URL, as the contract cuts them.
_URL_PARTS = """
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages"""

ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d
  FROM pages),
o AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN o.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN o.first < p.page_id THEN o.first END AS refers_to
FROM p LEFT JOIN o ON o.d = p.d""",
    "op3_url_filters": f"""
WITH u AS ({_URL_PARTS}),
r(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (
  SELECT u.page_id, u.host, u.path,
         arg_max(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict),
                 length(rule_host || rule_path)) FILTER (WHERE rule_host IS NOT NULL) AS best
  FROM u LEFT JOIN r
    ON (u.host = rule_host OR ends_with(u.host, '.' || rule_host))
       AND starts_with(u.path, rule_path)
  GROUP BY u.page_id, u.host, u.path)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM f""",
    "op11_hard_negatives": """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS a_r, a.vec_id AS anchor_id, c.r AS c_r, c.vec_id AS other_id,
         a.label = c.label AS same, CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.r <> c.r),
p AS (
  SELECT a_r, anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY a_r ORDER BY score DESC, other_id, c_r) AS place
  FROM s WHERE same QUALIFY place <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score,
         s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.a_r, p.place
                                 ORDER BY s.score DESC, s.other_id, s.c_r) AS INTEGER) AS rank
  FROM p JOIN s ON s.a_r = p.a_r AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3""",
    "op13_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
s AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
           len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
           100 * length(regexp_replace(s.t, '[^A-Z]', '', 'g')) > 3 * length(s.t),
           regexp_matches(s.t, '[#$%&*|]'),
           coalesce(s.doc_id > first_id, false)] AS fails
  FROM s JOIN firsts USING (t) LEFT JOIN marks ON marks.doc_id = s.doc_id),
c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS n_good, sum(toxic) AS n_toxic
  FROM f GROUP BY part, fails),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
r AS (
  SELECT c.*, filter_order,
         list_min(list_transform([1, 2, 3, 4, 5], lambda i:
           CASE WHEN fails[i] THEN strpos(filter_order, substr('ABCDE', i, 1)) ELSE 6 END)) AS gone
  FROM c, orders),
g AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step,
         strpos('ABCDE', substr(filter_order, step, 1)) AS own,
         CAST(sum(CASE WHEN gone > step THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN gone = step THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN gone < step AND fails[own] THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN fails[own] AND len(list_filter(fails, lambda b: b)) = 1
                       THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN gone = step THEN n_good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN gone = step THEN n_toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM r, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g""",
}
