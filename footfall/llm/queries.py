"""One query per operator over its whole table, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import (
    decontaminate,
    interactions,
    langid,
    mixing,
    periodic,
    pii,
    quality,
    rotation,
    secrets,
    sharding,
    simhash,
    substring,
    warc,
)
from footfall.session import scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return pii.find_personal(docs, pii.fit(docs))


def op3_langid_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir))


def op4_decontaminate_lsa(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(_documents(spark, sf_dir), benchmark).drop("text_hash")


def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.round_trip(pages, scratch_path(spark, "warc"))


def op6_mix_waterfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_substring_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(_documents(spark, sf_dir))


def op9_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return secrets.find_secrets(docs, secrets.fit(secrets.labelled_samples(docs)))


def op10_shard_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(_documents(spark, sf_dir))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.filter_interactions(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_simhash_golay,
            op2_pii_crf,
            op3_langid_ecoc,
            op4_decontaminate_lsa,
            op5_warc_zip,
            op6_mix_waterfill,
            op7_quality_rules,
            op8_substring_seed,
            op9_secret_markov,
            op10_shard_kdtree,
            op11_filter_interactions,
            op12_rotation_codes,
            op13_periodic_runs,
        )
    }


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first_page FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN f.first_page <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_page <> d.page_id THEN f.first_page END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest
"""

_MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
         substr(md5(concat_ws(':', '{mixing.SEED}', CAST(doc_id AS VARCHAR), text)), 1, 16) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s
), o AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS full_at FROM w
), r AS (
  SELECT *,
    (CAST((SELECT sum(source_size) FROM w) AS DOUBLE) - CAST(coalesce(sum(cap) OVER b, 0) AS DOUBLE))
    / CAST((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS level
  FROM o WINDOW b AS (ORDER BY full_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT arg_min(level, place_) AS level FROM (
    SELECT level, row_number() OVER (ORDER BY full_at, place) AS place_, full_at FROM r
  ) WHERE level <= full_at
), t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), l.level * weight) AS target FROM o, l
), x AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), c AS (
  SELECT d.doc_id, d.size, x.source_size, x.target, x.whole, x.target - x.whole * x.source_size AS extra,
    coalesce(sum(d.size) OVER (PARTITION BY x.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS ahead
  FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(least(whole + CASE WHEN 2 * ahead + size <= 2 * extra THEN 1 ELSE 0 END, 3) * size AS BIGINT) AS taken
FROM c
"""

_QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)
), q AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM q, range(5) AS steps(j) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    len(list_filter(words, lambda x: list_contains([{", ".join(f"'{w}'" for w in quality.STOP_WORDS)}], lower(x))))
      AS n_stop,
    coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN c ON c.doc_id = d.doc_id
), n AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed
    AND word_chars / n_words BETWEEN 2.0 AND 15.0
    AND n_symbols / n_words <= 0.1
    AND (n_words < 50 OR n_stop / n_words >= 0.02)
    AND (len(lines) = 0 OR n_dup_lines / len(lines) <= 0.35)
    AND n_repeat_words / n_words <= 0.2 AS kept
FROM n
"""

_SUBSTRING = rf"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS words FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY run) AS n FROM w) WHERE n > 1
), x AS (
  SELECT DISTINCT doc_id, i + j AS i FROM r, range(35) AS steps(j)
), p AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d
), k AS (
  SELECT p.doc_id, count(*) AS n_kept, string_agg(p.word, ' ' ORDER BY p.i) AS kept
  FROM p LEFT JOIN x ON x.doc_id = p.doc_id AND x.i = p.i WHERE x.i IS NULL GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

_INTERACTIONS = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), m AS (
  SELECT doc_id, part, [
      len(words) < 50,
      100 * len(list_distinct(words)) < 65 * len(words),
      100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
      regexp_matches(text, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)
    ] AS fails
  FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), w AS (
  SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
  FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY part, fails
), f(f, letter) AS (
  VALUES (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')
), o AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o, a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f)
    JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)
), r AS (
  SELECT part, fails, n, good, toxic, o, filter_order,
    CASE WHEN fails[o[1]] THEN 1 WHEN fails[o[2]] THEN 2 WHEN fails[o[3]] THEN 3 WHEN fails[o[4]] THEN 4
      WHEN fails[o[5]] THEN 5 ELSE 6 END AS rank
  FROM w, o
), s AS (
  SELECT part, filter_order, step, any_value(o[step]) AS f,
    sum(CASE WHEN rank > step THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN rank = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN rank < step AND fails[o[step]] THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[o[step]] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN rank = step THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN rank = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM r, (SELECT unnest(range(1, 6)) AS step) GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM s
"""

#: Fingerprints, checksums and trained models have no SQL form here; the tests check those queries.
ORACLE_SQL: dict[str, str] = {
    "op5_warc_zip": _WARC,
    "op6_mix_waterfill": _MIX,
    "op7_quality_rules": _QUALITY,
    "op8_substring_seed": _SUBSTRING,
    "op11_filter_interactions": _INTERACTIONS,
}
