"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import (decontaminate, html_extract, langid, lexical, minhash_dedup, nn_descent, packing, pii, quality_pu,
                            quality_rules, token_alignment, toxicity, warc)
from shelfspark.llm.common import fold, table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = fold(F.col("doc_id"), 5) != 0
    model = toxicity.fit(docs.filter(learn), labels.filter(learn))
    return toxicity.score(docs, model).select(
        "doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.fit(docs.filter(fold(F.col("doc_id"), 4) != 2))
    return langid.classify(docs, dictionaries).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("lang_guess").alias("lang_pred"), "score", "margin", (F.col("lang") == langid.UNKNOWN).alias("rejected"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = fold(F.col("doc_id"), 3) != 1
    model = quality_pu.fit(docs.filter(learn), labels.filter(learn))
    return quality_pu.score(docs, model).select(
        "doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.filtered(table(spark, sf_dir, "documents"))


def op11_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, neighbours=20)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_counts(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


QUERIES = {f.__name__: f for f in (
    op1_minhash_dedup,
    op2_best_fit_packing,
    op3_toxicity,
    op4_pii_pseudonyms,
    op5_html_extract,
    op6_decontamination,
    op7_language_id,
    op8_quality_classifier,
    op9_warc,
    op10_quality_rules,
    op11_nn_descent,
    op12_token_alignment,
    op13_lexical_search,
)}

# A word: a run of anything but the six ASCII white-space characters.
_WORDS = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

# Terms of the ranked search: all but ASCII characters other than letters and digits.
_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

STATEMENTS: dict[str, str] = {
    "op1_minhash_dedup": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS grams
  FROM w),
e AS (SELECT doc_id, unnest(grams) AS g FROM s),
n AS (SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM e a JOIN e b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * common >= 80 * (nx.n_shingles + ny.n_shingles - common)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM n
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT n.doc_id, n.n_shingles, min(y) AS component_id, n.doc_id = min(y) AS kept
FROM n JOIN reach ON reach.x = n.doc_id GROUP BY n.doc_id, n.n_shingles""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(encode(coalesce(html, ''))) AS payload_digest
  FROM pages),
c AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS chosen FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> chosen THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> chosen THEN chosen END AS refers_to
FROM c""",
    "op13_lexical_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
i AS (SELECT row_number() OVER () AS k, item_id, {_TERMS} AS ts FROM benchmark),
s AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS n_docs, CAST(coalesce(sum(len(ts)), 0) AS BIGINT) AS n_terms FROM d),
m AS (SELECT r, doc_id, 25 + (75 * CAST(len(ts) AS BIGINT) * n_docs) // n_terms AS m FROM d, s WHERE len(ts) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, s GROUP BY t, n_docs),
q AS (SELECT k, item_id, unnest(ts) AS t FROM i),
h AS (SELECT q.k, q.item_id, tf.r, m.doc_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY q.k, q.item_id, tf.r, m.doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM h WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 10""",
}
