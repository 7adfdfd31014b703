"""The queries of this package, by name, and the SQL that states them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    """Place of the word vocabulary on this machine (the operator takes it as a parameter)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.urlfilter import changes_by_rule, dated_captures, judge

    pages = table(spark, sf_dir, "pages")
    said = judge(dated_captures(pages), changes_by_rule(pages))
    second = lambda c: F.unix_seconds(c).alias(c)
    return said.select("page_id", "host", second("fetched_at"), "verdict", "pattern", second("since"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.warc import round_trip

    return round_trip(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents")).drop("_row", "ranges")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.simhash import hex_digits, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lettermill.llm.merkle import compare_neighbours

    return compare_neighbours(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH captures AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
         1704067200 + (page_id * 7919) % 31622400 AS moment
  FROM pages
), hosts AS (
  SELECT DISTINCT host, strpos('0123456789abcdef', substr(md5(host), 1, 1)) - 1 AS kind,
         1704067200 + 86400 * (16 * (strpos('0123456789abcdef', substr(md5(host), 2, 1)) - 1) + strpos('0123456789abcdef', substr(md5(host), 3, 1)) - 1) AS day
  FROM captures WHERE host <> ''
), changes AS (
  SELECT host AS pattern, 'block' AS action, 'add' AS change, day AS moment FROM hosts WHERE kind < 4
  UNION SELECT host, 'block', 'remove', day + 60 * 86400 FROM hosts WHERE kind < 4
  UNION SELECT host, 'block', 'add', day + 120 * 86400 FROM hosts WHERE kind < 4
  UNION SELECT regexp_replace(host, '^[^.]*\.', ''), 'block', 'add', day FROM hosts WHERE kind IN (4, 5)
  UNION SELECT host || '/en/', 'block', 'add', day FROM hosts WHERE kind IN (6, 7)
  UNION SELECT host, 'allow', 'add', day FROM hosts WHERE kind IN (8, 9)
  UNION SELECT host, 'allow', 'remove', day + 200 * 86400 FROM hosts WHERE kind IN (8, 9)
), spans AS (
  SELECT pattern, action, change, moment AS since,
         lead(moment) OVER (PARTITION BY pattern ORDER BY moment, CASE WHEN change = 'remove' THEN 1 ELSE 0 END, action) AS until
  FROM changes
), found AS (
  SELECT c.page_id, s.pattern, s.action, s.since,
         row_number() OVER (PARTITION BY c.page_id ORDER BY contains(s.pattern, '/') DESC,
           length(split_part(s.pattern, '/', 1)) - length(replace(split_part(s.pattern, '/', 1), '.', '')) DESC, s.action, s.pattern DESC) AS rank
  FROM captures c JOIN spans s ON s.change = 'add' AND (s.until IS NULL OR s.until > s.since)
    AND s.since <= c.moment AND (s.until IS NULL OR c.moment < s.until)
    AND (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern) OR starts_with(c.host || c.path, s.pattern) AND contains(s.pattern, '/'))
)
SELECT c.page_id, c.host, CAST(c.moment AS BIGINT) AS fetched_at, coalesce(f.action, 'none') AS verdict, f.pattern, CAST(f.since AS BIGINT) AS since
FROM captures c LEFT JOIN found f ON f.page_id = c.page_id AND f.rank = 1
"""

OP4_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, max(page_id) AS first FROM payloads WHERE strlen(html) >= 1000 GROUP BY html)
SELECT p.page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON f.html = p.html
"""

OP9_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), ranked AS (
  SELECT source, source_size, 2.0 * source_size AS cap,
         CASE k % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END AS weight,
         CASE k % 3 WHEN 0 THEN -0.5 WHEN 1 THEN 0.0 ELSE 0.5 END AS tilt, k
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
        FROM sizes GROUP BY source)
), leveled AS (
  SELECT *, ((sum(source_size) OVER ()) * CAST(1.5 AS DOUBLE) - coalesce(sum(cap) OVER before, 0.0))
          / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0.0)) AS level
  FROM (SELECT source, source_size, CAST(cap AS DOUBLE) AS cap, CAST(weight AS DOUBLE) AS weight, CAST(tilt AS DOUBLE) AS tilt, k FROM ranked)
  WINDOW before AS (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, tilt, coalesce(least(cap, weight * (
    SELECT level FROM leveled WHERE cap >= level * weight ORDER BY cap / weight, k LIMIT 1)), cap) AS target
  FROM leveled
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.tilt,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source
           ORDER BY md5(concat_ws(':', coalesce(CAST(s.doc_id AS VARCHAR), ''), CAST(s.size AS VARCHAR))), s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - start)) AS first_pass,
         greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - start)) AS second_pass,
         CAST(start AS DOUBLE) / target AS share
  FROM placed
)
SELECT doc_id, size, source_size, target, CAST(first_pass + second_pass AS BIGINT) AS taken,
       CASE WHEN first_pass > 0 THEN (share * 2.0) / ((1.0 - tilt) + sqrt((1.0 - tilt) * (1.0 - tilt) + tilt * share * 4.0)) END AS position
FROM taken
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL, "op4_warc": OP4_SQL, "op9_mixing": OP9_SQL}
