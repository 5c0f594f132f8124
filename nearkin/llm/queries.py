"""The operators of this folder as registered queries, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from nearkin.llm import backoff_lm, bottom_k, bpe, exact_shuffle, fm_index, kd_search, language_id, lexical_search, page_template, quality_gam, secret_scan, string_kernel, whitening
from nearkin.llm.common import id_remainder, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def quality_model(spark: SparkSession, folder: str) -> quality_gam.Model:
    return quality_gam.fit(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out=id_remainder("doc_id", 4) == 2)


def op1_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_gam.score(table(spark, folder, "documents").select("doc_id", "text"), quality_model(spark, folder))
    return scored.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(table(spark, folder, "documents"))


def op4_page_template(spark: SparkSession, folder: str) -> DataFrame:
    return page_template.extract(table(spark, folder, "pages"))


def op5_fm_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return fm_index.digests(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_bottom_k_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k.near_duplicates(table(spark, folder, "documents"))


def op7_exact_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return exact_shuffle.digests(table(spark, folder, "documents"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    found, names = language_id.identify(documents.select("doc_id", "text"), language_id.fit(documents, held_out=held_out))
    return found.select("doc_id", held_out.alias("held_out"), *names.values())


def op9_kd_search(spark: SparkSession, folder: str) -> DataFrame:
    return kd_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    return backoff_lm.score(table(spark, folder, "documents"), id_remainder("doc_id", 10) == 0, contexts=True)


def op11_interval_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = table(spark, folder, "documents"), id_remainder("doc_id", 5) == 0
    model = string_kernel.fit(documents, table(spark, folder, "labels"), held_out=held_out)
    return string_kernel.score(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= string_kernel.THRESHOLD).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secret_scan": op3_secret_scan,
    "op4_page_template": op4_page_template,
    "op5_fm_decontamination": op5_fm_decontamination,
    "op6_bottom_k_dedup": op6_bottom_k_dedup,
    "op7_exact_shuffle": op7_exact_shuffle,
    "op8_language_id": op8_language_id,
    "op9_kd_search": op9_kd_search,
    "op10_backoff_lm": op10_backoff_lm,
    "op11_interval_search": op11_interval_search,
    "op12_whitening": op12_whitening,
    "op13_string_kernel": op13_string_kernel,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+')"
_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op5_fm_decontamination": f"""WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
      b AS (SELECT item_id, w, least(len(w), 10) AS l FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
      wanted AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS i FROM b)),
      held AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS s FROM (
        SELECT *, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM wanted) WHERE len(w) >= l)),
      hits AS (SELECT doc_id, i, l, item_id FROM held JOIN wanted USING (l, s)),
      words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM hits)) GROUP BY 1),
      items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
      SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
      FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_bottom_k_dedup": f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
      placed AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
      sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM placed),
      sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
      common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
      links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
      reached AS (SELECT doc_id AS id, doc_id AS r FROM d UNION SELECT y, r FROM reached JOIN links ON x = id),
      least_one AS (SELECT id, min(r) AS component_id FROM reached GROUP BY 1)
      SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
      FROM d JOIN least_one ON id = doc_id LEFT JOIN sizes USING (doc_id)""",
    "op9_kd_search": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
      SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op11_interval_search": f"""WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
      d2 AS (SELECT row_number() OVER () AS r, doc_id, w, len(w)::BIGINT AS n FROM d),
      size AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM d2 WHERE n > 0),
      tf AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(w) AS t FROM d2) GROUP BY ALL),
      df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY 1),
      asked AS (SELECT item_id, t, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
      scored AS (SELECT item_id, r, doc_id, sum(times * floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT
          * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
        FROM asked JOIN tf USING (t) JOIN df USING (t), size GROUP BY ALL),
      ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
        FROM scored WHERE score > 0)
      SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
