"""Named queries of the training-data operators, each over its whole table, with SQL
restatements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from offerlake.llm import (decontaminate, exact_dedup, language_id, license_scan, minhash_dedup, mixing,
                           ranked_search, sharding, substring_dedup, token_counts, toxicity, url_filter, whitening)
from offerlake.llm.common import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), spark).select(
        "doc_id", "class_id", "class_size", "kept")


def op2_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), spark, shards=24)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spark).select(
        "doc_id", "contaminated", "n_items", "item_ids")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), spark)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"), spark)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), spark)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), spark)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), spark)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), spark)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.token_counts(table(spark, sf_dir, "documents"), spark, public_tokenizers.path("piece_bpe_32k.model"))


def op12_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_table(table(spark, sf_dir, "embeddings"), spark)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_near_duplicates, op2_shard_documents, op3_url_filter, op4_decontaminate, op5_mix_sources, op6_license_scan,
        op7_substring_dedup, op8_toxicity, op9_language_id, op10_exact_dedup,
        op11_token_counts, op12_whiten_embeddings, op13_ranked_search)}


OP7_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
s AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35),
k AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h FROM s),
r AS (SELECT doc_id, i FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM r),
g AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(coalesce(gone, []))::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""

OP10_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


OP13_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
iw AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
lens AS (SELECT r, doc_id, count(*) AS n FROM dw GROUP BY r, doc_id),
g AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM lens),
tf AS (SELECT r, t, count(*) AS tf FROM dw GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
it AS (SELECT i, item_id, t, count(*) AS q FROM iw GROUP BY i, item_id, t),
s AS (SELECT i, item_id, lens.r, lens.doc_id,
             sum(q * floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * df + 1)))::BIGINT
                 * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * nn) // ll)))))::BIGINT AS score
      FROM it JOIN tf USING (t) JOIN df USING (t) JOIN lens ON lens.r = tf.r, g GROUP BY i, item_id, lens.r, lens.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_substring_dedup": OP7_SQL, "op10_exact_dedup": OP10_SQL, "op13_ranked_search": OP13_SQL}
