"""The corpus operators on the driver tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (conversation_repair, dart_minhash, decontaminate, html_density, language_id, licences, mixing, packing,
               perfect_hash_dedup, quality_rules, simplex_clusters, token_coder, zip_warc)
from .common import table

WORD = r"[^\x20\x09-\x0D]+"


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every page."""
    return html_density.extract(table(spark, sf_dir, "pages"))


def op3_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back by range."""
    return zip_warc.round_trip(table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the share of it they hold."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that every document names."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentences", ",").alias("sentences"),
                        F.array_join("licences", ",").alias("licences"), F.col("unmatched").cast("long").alias("unmatched"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page."""
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least id of its class of near copies."""
    found = dart_minhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the targets of their sources."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written to compressed files and read back."""
    return token_coder.round_trip(table(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, equal texts together."""
    rows = packing.slots(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector with its cluster, its squared distance and the sums of these."""
    return simplex_clusters.cluster(table(spark, sf_dir, "embeddings"))[0]


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equals. About half of the documents, by a hash of the id, are taken
    as history, the others as a delivery that is held against it."""
    return perfect_hash_dedup.deduplicate(table(spark, sf_dir, "documents"), F.xxhash64("doc_id") % 2 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults and cheapest repair."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.report(rows, F.col("here"))


def _shingles_sql(table_name: str, key: str) -> str:
    """Different five-word windows of each text of a table, lower case."""
    words = f"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
      FROM (SELECT {key}, {words} AS w FROM {table_name})"""


OP2_SQL = f"""
WITH d AS ({_shingles_sql("documents", "doc_id")}), i AS ({_shingles_sql("benchmark", "item_id")}),
  n AS (SELECT item_id, count(*) AS total FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) / any_value(total)::DOUBLE AS containment
FROM i JOIN d USING (shingle) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(total)
"""

OP12_SQL = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h,
                  length(coalesce(text, '')) AS chars FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY chars DESC, doc_id NULLS LAST)
"""


def _clusters_sql() -> str:
    """Seeds, three rounds of assignment and floor of the mean, and the last assignment, all in whole numbers."""
    steps = ["""k AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             """c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS INTEGER) AS c, v
      FROM k QUALIFY c < 16)"""]
    for n in range(simplex_clusters.ROUNDS + 1):
        steps.append(f"""a{n} AS (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min((d, c)) AS best FROM (
        SELECT r, vec_id, k.v, c, CAST(list_sum(list_transform(list_zip(k.v, c{n}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM k, c{n}) GROUP BY r)""")
        if n < simplex_clusters.ROUNDS:
            steps.append(f"""m{n} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
        SELECT best[2] AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{n}, range(1, 65) x(i) GROUP BY 1, 2) GROUP BY c)""")
            steps.append(f"c{n + 1} AS (SELECT c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (c))")
    last = simplex_clusters.ROUNDS
    return f"""WITH {", ".join(steps)}
SELECT vec_id, best[2] AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
       CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON best[2] = c"""


QUERIES = {
    "op2_decontamination": (op2_decontamination, OP2_SQL),
    "op1_main_text": (op1_main_text, None),
    "op3_zip_warc": (op3_zip_warc, None),
    "op4_licences": (op4_licences, licences.scan_sql()),
    "op8_language": (op8_language, None),
    "op5_near_duplicates": (op5_near_duplicates, None),
    "op6_mix": (op6_mix, None),
    "op7_quality_rules": (op7_quality_rules, None),
    "op9_token_files": (op9_token_files, None),
    "op10_shards": (op10_shards, None),
    "op11_centroids": (op11_centroids, _clusters_sql()),
    "op12_exact_dedup": (op12_exact_dedup, OP12_SQL),
    "op13_conversation_repair": (op13_conversation_repair, None),
}
