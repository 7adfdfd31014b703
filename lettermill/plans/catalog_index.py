"""Named queries that run the archive's own operators on mail made from documents, each with the SQL that states it.

Every document is a stored message; a third of them are stored again as scraped copies. Shards, logs and files are
written to scratch by the library's sinks and read back by its sources.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.functions import ids, mail, mime, text
from lettermill.operators import dedup, pages, tallies, threads, validate
from lettermill.plans import index, publish
from lettermill.plans.catalog import query
from lettermill.profile import Profile
from lettermill.session import make_folder, materialize, scratch, shuffle_width, table
from lettermill.sinks import logs
from lettermill.sinks.export import export, newest_ts, remove_stale, status_document
from lettermill.sources import archive, shards
from lettermill.streaming import ingest

START, STEP = 1262304000, 36000
_ADVISORY = "translate(lpad(CAST(doc_id % 100 AS VARCHAR), 4, '2'), '01', 'ch')"
_M = f"""m AS (SELECT doc_id, text, ts, strftime(make_timestamp(ts * 1000000), '%Y') AS shard, strftime(make_timestamp(ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS date, 'd' || doc_id || '@x.org' AS message_id,
'd' || base || '@x.org' AS thread_root, CASE WHEN base <> doc_id THEN 'd' || base || '@x.org' END AS in_reply_to, cve, ghsa, 'On ' || cve || CASE WHEN ghsa IS NULL THEN '' ELSE ' and ' || lower(ghsa) END AS subject,
CASE WHEN doc_id % 3 = 0 THEN 'https://archive.example.org/list/2024/01/01/' || doc_id ELSE 'https://archive.example.org/list/' || strftime(make_timestamp(ts * 1000000), '%Y/%m/%d') END AS url,
doc_id % 3 = 0 AS twice, base FROM (SELECT doc_id, coalesce(text, '') AS text, {START} + doc_id * {STEP} AS ts, doc_id - doc_id % 10 AS base, 'CVE-' || (2000 + doc_id % 20) || '-' || (1000 + doc_id % 50) AS cve,
CASE WHEN doc_id % 7 = 0 THEN 'GHSA-2222-3333-' || {_ADVISORY} END AS ghsa FROM documents))"""
_HEAD = """'Message-ID:' || chr(10) || ' <' || message_id || '>' || chr(10) || 'Date: ' || strftime(make_timestamp(ts * 1000000), '%a, %-d %b %Y %H:%M:%S +0000') || chr(10) || 'From: Writer <w@x.org>' || chr(10) || 'Subject: ' || subject
|| chr(10) || 'Content-Type: text/plain; charset=utf-8' || chr(10)"""
_RAW = f"{_HEAD} || 'In-Reply-To: <' || thread_root || '>' || chr(10) || chr(10) || text"
_AGAIN = f"'X-Archive-Source: scrape' || chr(10) || 'X-Archive-Source-URL: https://archive.example.org/list/2024/01/01/' || doc_id || chr(10) || {_HEAD} || chr(10) || text || chr(10) || 'footer'"


def _quoted(c: str) -> str:
    """SQL of a JSON string."""
    return f"""'"' || replace(replace(replace(replace({c}, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't') || '"'"""


def _blob(raw: str) -> str:
    return f"sha1('blob ' || strlen({raw}) || chr(0) || {raw})"


def made_log(spark: SparkSession, d: str, times: int = 1) -> DataFrame:
    """STORED rows; every tenth document starts a thread (it names itself as its parent) that the nine after it reply to."""
    # Documents are spread, not the messages made from them: a message's copies are made where its document is.
    docs = _spread(table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    if times > 1:  # every document as so many messages
        docs = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("k")).select((F.col("doc_id") * times + F.col("k")).alias("doc_id"), "text")
    k = lambda c: c.cast("string")
    doc = F.col("doc_id")
    date = F.date_format(F.timestamp_seconds(F.lit(START) + doc * STEP), "EEE, d MMM yyyy HH:mm:ss '+0000'")
    advisory = F.when(doc % 7 == 0, F.concat(F.lit(" and ghsa-2222-3333-"), F.translate(F.lpad(k(doc % 100), 4, "2"), "01", "ch"))).otherwise("")
    subject = F.concat(F.lit("On CVE-"), k(2000 + doc % 20), F.lit("-"), k(1000 + doc % 50), advisory)
    head = F.concat(F.lit("Message-ID:\n <d"), k(doc), F.lit("@x.org>\nDate: "), date, F.lit("\nFrom: Writer <w@x.org>\nSubject: "), subject, F.lit("\nContent-Type: text/plain; charset=utf-8\n"))
    reply = F.concat(F.lit("In-Reply-To: <d"), k(doc - doc % 10), F.lit("@x.org>\n"))
    scraped = F.concat(F.lit("X-Archive-Source: scrape\nX-Archive-Source-URL: https://archive.example.org/list/2024/01/01/"), k(doc), F.lit("\n"))
    full = F.struct((2 * doc).alias("seq"), F.concat(head, reply, F.lit("\n"), "text").alias("raw"))
    again = F.struct((2 * doc + 1).alias("seq"), F.concat(scraped, head, F.lit("\n"), "text", F.lit("\nfooter")).alias("raw"))
    return _as_log(docs.select(F.explode(F.when(doc % 3 == 0, F.array(full, again)).otherwise(F.array(full))).alias("m")).select("m.*"))


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """A log comes in ranges of commits, whatever files its stand-in is in."""
    return rows.repartition(2 * shuffle_width(rows.sparkSession), key)


def _as_log(rows: DataFrame) -> DataFrame:
    raw = rows.withColumn("raw", F.encode("raw", "UTF-8"))
    return raw.select("seq", F.lit(0).alias("epoch"), F.lit("c").alias("commit"), F.lit(32503680000).cast("long").alias("commit_ts"), ids.blob_id(F.col("raw")).alias("blob"), "raw")


def _stored(rows: DataFrame) -> DataFrame:
    return _as_log(_spread(rows, "seq"))


_BUILT: dict[tuple[str, str], index.Index] = {}
_PUBLISHED: dict[tuple[str, str], tuple[str, dict, index.Index]] = {}


def _built(spark: SparkSession, d: str) -> index.Index:
    """Tables of the index of made_log, built once in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _BUILT:
        _BUILT[key] = index.build(made_log(spark, d), Profile())
    return _BUILT[key]


def _published(spark: SparkSession, d: str) -> tuple[str, dict, index.Index]:
    """Folder, manifest and tables of that index, written once in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _PUBLISHED:
        built = _built(spark, d)
        home = make_folder(spark, scratch(spark, "index"))
        _PUBLISHED[key] = home, export(built, home, "list", generated_at=0), built
    return _PUBLISHED[key]


def _lines(spark: SparkSession, d: str, kind: str = "messages") -> DataFrame:
    return shards.read_lines(spark, _published(spark, d)[0], kind)


def _mentions(spark: SparkSession, d: str, kind: str = "cves") -> DataFrame:
    return shards.read_mentions(spark, _published(spark, d)[0], kind)


def _number(c: str = "message_id"):
    """doc_id of a message id."""
    return F.regexp_extract(c, r"^d(\d+)@", 1).cast("long")


def _only(checks: DataFrame, name: str) -> DataFrame:
    return checks.filter(F.col("check") == name)


# ---- the whole way ----


@query(f"""WITH {_M} SELECT message_id, 'maildir' AS provenance, CASE WHEN twice THEN 'scrape' ELSE '' END AS duplicates, false AS body_conflict, date, 'date' AS date_source, subject, in_reply_to, thread_root, url,
cve AS cve_ids, coalesce(ghsa, '') AS ghsa_ids, left(sha256(text), 12) AS body_sha FROM m""")
def index_messages(spark, d):
    messages = index.build(made_log(spark, d), Profile()).messages
    lists = {"duplicates": F.array_join(F.transform("duplicates", lambda x: x["provenance"]), ","), "cve_ids": F.array_join("cve_ids", ","), "ghsa_ids": F.array_join("ghsa_ids", ",")}
    names = ("message_id", "provenance", "duplicates", "body_conflict", "date", "date_source", "subject", "in_reply_to", "thread_root", "url", "cve_ids", "ghsa_ids", "body_sha")
    return messages.select(*[lists.get(n, F.col(n)).alias(n) for n in names])


_ITEM = f"""'{{"message_id":' || {_quoted("message_id")} || ',"date":' || {_quoted("date")} || ',"url":' || {_quoted("url")} || ',"thread_root":' || {_quoted("thread_root")} || '}}'"""
_MESSAGE = f"""'{{"message_id":' || {_quoted("message_id")} || ',"synthetic_mid":false,"epoch":0,"blob":"' || {_blob(_RAW)} || '","duplicates":[' || CASE WHEN twice THEN '{{"blob":"' || {_blob(_AGAIN)} || '","provenance":"scrape"}}' ELSE '' END
|| '],"body_conflict":false,"date":"' || date || '","date_source":"date","from":"Writer <w@x.org>","subject":' || {_quoted("subject")} || ',"in_reply_to":' || coalesce({_quoted("in_reply_to")}, 'null') || ',"thread_root":' || {_quoted("thread_root")}
|| ',"url":' || {_quoted("url")} || ',"provenance":"maildir","cve_ids":["' || cve || '"],"ghsa_ids":[' || coalesce('"' || ghsa || '"', '') || '],"body_sha":"' || left(sha256(text), 12) || '"}}'"""
_BODY = f"""'{{"message_id":' || {_quoted("message_id")} || ',"body":' || {_quoted("text")} || ',"truncated":false}}'"""


def _lists(column: str, shard: str) -> str:
    """SQL: shards of id maps as (shard, count, data)."""
    return f"""SELECT shard, count(*) AS n, chr(123) || chr(10) || string_agg(line, ',' || chr(10) ORDER BY id) || chr(10) || chr(125) || chr(10) AS data FROM
(SELECT {shard} AS shard, {column} AS id, '"' || {column} || '":[' || string_agg({_ITEM}, ',' ORDER BY ts, message_id) || ']' AS line FROM m WHERE {column} IS NOT NULL GROUP BY 1, 2) GROUP BY shard"""


_SHARDS = f"""WITH {_M}, s AS (SELECT 'messages' AS kind, shard, count(*) AS n, string_agg({_MESSAGE}, chr(10) ORDER BY ts, message_id) || chr(10) AS data FROM m GROUP BY shard
UNION ALL SELECT 'bodies', shard, count(*), string_agg({_BODY}, chr(10) ORDER BY ts, message_id) || chr(10) FROM m GROUP BY shard
UNION ALL SELECT 'cves', * FROM ({_lists("cve", "substr(cve, 5, 4)")}) UNION ALL SELECT 'ghsas', * FROM ({_lists("ghsa", "'all'")}))"""


@query(f"{_SHARDS} SELECT kind, shard, CAST(n AS BIGINT) AS count, sha256(data) AS sha256, CASE WHEN kind = 'bodies' THEN CAST(strlen(data) AS BIGINT) END AS bytes FROM s")
def index_export(spark, d):
    """The manifest rows of a whole index, written to scratch (K1 to K6): every byte of every shard."""
    built = index.build(made_log(spark, d), Profile())
    return shards.manifest_rows(spark, export(built, make_folder(spark, scratch(spark, "index")), "list", generated_at=0))


@query(None)  # five times the messages, for a throughput figure
def index_export_large(spark, d):
    built = index.build(made_log(spark, d, 5), Profile())
    return shards.manifest_rows(spark, export(built, make_folder(spark, scratch(spark, "index")), "list", generated_at=0))


# ---- shards and documents read back ----


@query(f"WITH {_M} SELECT shard, message_id, subject, date, CAST(row_number() OVER (PARTITION BY shard ORDER BY ts, message_id) AS BIGINT) AS place FROM m")
def s10_message_lines(spark, d):
    order = Window.partitionBy("shard").orderBy("row")  # as stored: one shard is one ordered list
    return _lines(spark, d).select("shard", "message_id", "subject", "date", F.row_number().over(order).cast("long").alias("place"))


@query(f"WITH {_M} SELECT shard, message_id, sha256(text) AS body, false AS truncated FROM m")
def k2_body_lines(spark, d):
    return _lines(spark, d, "bodies").select("shard", "message_id", F.sha2(F.col("body").cast("binary"), 256).alias("body"), "truncated")


@query(f"WITH {_M} SELECT substr(cve, 5, 4) AS shard, cve AS id, CAST(row_number() OVER (PARTITION BY cve ORDER BY ts, message_id) - 1 AS INTEGER) AS pos, message_id, date, url, thread_root FROM m")
def s11_mention_lines(spark, d):
    return _mentions(spark, d)


@query(f"WITH {_M} SELECT 'all' AS shard, ghsa AS id, CAST(row_number() OVER (PARTITION BY ghsa ORDER BY ts, message_id) - 1 AS INTEGER) AS pos, message_id, date, url, thread_root FROM m WHERE ghsa IS NOT NULL")
def k4_advisory_lines(spark, d):
    return _mentions(spark, d, "ghsas")


@query(f"{_SHARDS} SELECT kind, shard, CAST(n AS BIGINT) AS count, CAST(strlen(data) AS BIGINT) AS bytes, sha256(data) AS sha256 FROM s")
def s12_shards_on_disk(spark, d):
    return shards.measured_files(spark, _published(spark, d)[0])


@query(f"""WITH {_M} SELECT 1 AS "schema", 'list' AS source, '1970-01-01T00:00:00Z' AS generated_at, CAST(count(*) AS BIGINT) AS total_messages, CAST(count(*) + count(*) FILTER (WHERE twice) AS BIGINT) AS total_stored,
CAST(count(DISTINCT cve) AS BIGINT) AS total_cves, CAST(count(DISTINCT ghsa) AS BIGINT) AS total_ghsas FROM m""")
def s13_manifest(spark, d):
    told = shards.read_document(spark, f"{_published(spark, d)[0]}/manifest.json")
    names = ("schema", "source", "generated_at", "total_messages", "total_stored", "total_cves", "total_ghsas")
    return spark.createDataFrame([tuple(told[n] for n in names)], "schema int, source string, generated_at string, total_messages long, total_stored long, total_cves long, total_ghsas long")


@query(f"WITH {_M} SELECT max(ts) AS newest, arg_max(message_id, ts) AS last_id FROM m")
def s16_last_row(spark, d):
    newest = newest_ts(_published(spark, d)[2].messages)
    last = _lines(spark, d).agg(F.max_by("message_id", F.struct("shard", "row")).alias("last_id"))
    return last.select(F.lit(newest).cast("long").alias("newest"), "last_id")


@query("SELECT 'messages/1999.jsonl' AS gone UNION ALL SELECT 'cves/1066.json'")
def k7_stale_shards(spark, d):
    home, manifest, _ = _published(spark, d)
    out = make_folder(spark, scratch(spark, "stale"))
    for kind in ("messages", "bodies", "cves", "ghsas"):
        make_folder(spark, f"{out}/{kind}")
    for name in ("messages/1999.jsonl", "cves/1066.json", "ghsas/all.json", f"messages/{min(manifest['messages'])}.jsonl", "messages/notes.txt"):
        publish.put_document(spark, f"{out}/{name}", "x\n")
    return spark.createDataFrame([(x,) for x in remove_stale(spark, out, manifest)], "gone string")


def _status(spark: SparkSession, d: str, ok: bool = True) -> dict:
    home, manifest, built = _published(spark, d)
    newest = newest_ts(built.messages)
    path = f"{make_folder(spark, scratch(spark, 'status'))}/status.json"
    first = status_document({}, manifest, True, newest + 20_000, newest, (3, 1, "boom"), newest, system="list")
    publish.put_document(spark, path, json.dumps(first))
    if not ok:
        publish.put_document(spark, path, json.dumps(status_document(shards.read_document(spark, path), {}, False, newest + 30_000, newest, (0, 0, None), newest, "V6 seeded")))
    return shards.read_document(spark, path)


def _status_row(spark: SparkSession, doc: dict) -> DataFrame:
    row = (doc["last_run"]["status"], doc["last_run"]["duration_s"], doc["last_run"]["imported"], doc["last_run"]["failed"], doc["last_run"]["top_error"], doc["freshness"]["source_lag_s"], doc["counts"]["messages"], doc["counts"]["stored"], doc["counts"]["duplicates"], "; ".join(doc["problems"]))
    return spark.createDataFrame([row], "status string, duration_s long, imported long, failed long, top_error string, source_lag_s long, messages long, stored long, duplicates long, problems string")


_COUNTS = "CAST(count(*) AS BIGINT) AS messages, CAST(count(*) + count(*) FILTER (WHERE twice) AS BIGINT) AS stored, CAST(count(*) FILTER (WHERE twice) AS BIGINT) AS duplicates"


@query(f"WITH {_M} SELECT 'ok' AS status, CAST(20000 AS BIGINT) AS duration_s, CAST(3 AS BIGINT) AS imported, CAST(1 AS BIGINT) AS failed, 'boom' AS top_error, CAST(20000 AS BIGINT) AS source_lag_s, {_COUNTS}, '1 message(s) failed ingest this run' AS problems FROM m")
def q7_archive_health(spark, d):
    return _status_row(spark, _status(spark, d))


@query(f"WITH {_M} SELECT 'error' AS status, CAST(30000 AS BIGINT) AS duration_s, CAST(0 AS BIGINT) AS imported, CAST(0 AS BIGINT) AS failed, 'V6 seeded' AS top_error, CAST(NULL AS BIGINT) AS source_lag_s, {_COUNTS}, 'V6 seeded' AS problems FROM m")
def k8_status_of_a_failed_run(spark, d):
    return _status_row(spark, _status(spark, d, ok=False))


@query("SELECT CAST(20000 AS BIGINT) AS source_lag_s, true AS late")
def a16_lag(spark, d):
    told = _status(spark, d)["freshness"]
    return spark.createDataFrame([(told["source_lag_s"], told["source_lag_s"] > told["expected_interval_s"])], "source_lag_s long, late boolean")


@query(f"""WITH {_M} SELECT CAST(count(*) + count(*) FILTER (WHERE twice) AS BIGINT) AS stored, CAST(count(*) AS BIGINT) AS "unique", CAST(count(*) FILTER (WHERE twice) AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS conflicts, CAST(0 AS BIGINT) AS fallback_dates,
max(ts) AS newest, CAST(count(DISTINCT cve) AS BIGINT) AS cves, CAST(count(DISTINCT ghsa) AS BIGINT) AS ghsas FROM m""")
def a14_summary(spark, d):
    told = publish.summary(spark, _published(spark, d)[0])
    names = ("stored", "unique", "duplicates", "conflicts", "fallback_dates", "newest", "cves", "ghsas")
    return spark.createDataFrame([tuple(told[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query(f"{_SHARDS}, b AS (SELECT sum(strlen(data)) AS bytes FROM s WHERE kind = 'bodies') SELECT CAST(count(*) + count(*) FILTER (WHERE twice) AS BIGINT) AS stored, CAST(count(*) AS BIGINT) AS messages, CAST(any_value(bytes) AS BIGINT) AS bytes FROM m, b")
def a6_totals(spark, d):
    told = publish.summary(spark, _published(spark, d)[0])
    return spark.createDataFrame([(told["stored"], told["unique"], told["bytes"])], "stored long, messages long, bytes long")


# ---- checks of a damaged index ----


@query(f"WITH {_M} SELECT 'V5' AS \"check\", shard, CAST(count(*) AS BIGINT) AS n FROM m WHERE doc_id % 97 = 1 GROUP BY shard")
def v5_unreadable_lines(spark, d):
    damaged = _lines(spark, d).withColumn("message_id", F.when(_number() % 97 != 1, F.col("message_id")))
    return _only(validate.check_messages(damaged), "V5").groupBy("check", "shard").agg(F.count("*").alias("n"))


@query(f"WITH {_M} SELECT 'V6' AS \"check\", shard, message_id AS id, '2' AS detail FROM m WHERE doc_id % 40 = 0")
def v6_repeated_ids(spark, d):
    rows = _lines(spark, d)
    return _only(validate.check_messages(rows.unionByName(rows.filter(_number() % 40 == 0))), "V6")


@query(f"WITH {_M} SELECT 'V7' AS \"check\", shard, message_id AS id, CASE WHEN doc_id % 50 = 0 THEN 'someday' ELSE '1999-01-01T00:00:00Z' END AS detail FROM m WHERE doc_id % 50 < 2")
def v7_dates_and_shards(spark, d):
    kind = _number() % 50
    damaged = _lines(spark, d).withColumn("date", F.when(kind == 0, "someday").when(kind == 1, "1999-01-01T00:00:00Z").otherwise(F.col("date")))
    return _only(validate.check_messages(damaged), "V7")


@query(f"WITH {_M}, o AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY ts, message_id) AS place FROM m) SELECT 'V8' AS \"check\", shard, message_id AS id, '0000' AS detail FROM o WHERE doc_id % 50 = 7 AND place > 1")
def v8_order(spark, d):
    damaged = _lines(spark, d).withColumn("date", F.when(_number() % 50 == 7, "0000").otherwise(F.col("date")))
    return _only(validate.check_messages(damaged), "V8")


@query(f"WITH {_M} SELECT 'V9' AS \"check\", shard, message_id AS id FROM m WHERE doc_id % 30 IN (1, 2)")
def v9_lists(spark, d):
    kind = _number() % 30
    damaged = _lines(spark, d).withColumns({"duplicates": F.when(kind != 1, F.col("duplicates")), "thread_root": F.when(kind != 2, F.col("thread_root"))})
    return _only(validate.check_messages(damaged), "V9").drop("detail")


def _body_checks(spark: SparkSession, d: str, bodies: DataFrame, name: str) -> DataFrame:
    return _only(validate.check_bodies(_lines(spark, d), bodies), name)


@query(f"WITH {_M} SELECT 'V11' AS \"check\", shard, message_id AS id, 'other' AS detail FROM m WHERE doc_id % 60 = 4")
def v11_bodies_by_position(spark, d):
    return _body_checks(spark, d, _lines(spark, d, "bodies").withColumn("message_id", F.when(_number() % 60 == 4, "other").otherwise(F.col("message_id"))), "V11")


@query(f"WITH {_M} SELECT 'V12' AS \"check\", shard, message_id AS id, left(sha256(text), 12) AS detail FROM m WHERE doc_id % 60 = 5")
def v12_body_digests(spark, d):
    return _body_checks(spark, d, _lines(spark, d, "bodies").withColumn("body", F.when(_number() % 60 == 5, F.concat("body", F.lit("~"))).otherwise(F.col("body"))), "V12")


@query(f"WITH {_M}, l AS (SELECT shard, max(ts) AS ts FROM m GROUP BY shard) SELECT 'V13' AS \"check\", shard, message_id AS id, 'message only' AS detail FROM m JOIN l USING (shard, ts)")
def v13_bodies_without_messages(spark, d):
    rows = _lines(spark, d, "bodies")
    last = rows.groupBy("shard").agg(F.max("row").alias("_last"))  # a row for each shard
    bodies = rows.join(F.broadcast(last), "shard").filter("row < _last").drop("_last")
    return _body_checks(spark, d, bodies, "V13")


@query(f"WITH {_M} SELECT 'V14' AS \"check\", '1066' AS shard, cve AS id, CAST(count(*) AS BIGINT) AS n FROM m WHERE doc_id % 50 = 9 GROUP BY cve")
def v14_misplaced_ids(spark, d):
    found = _mentions(spark, d).withColumn("shard", F.when(F.col("id").endswith("-1009"), "1066").otherwise(F.col("shard")))
    return _only(validate.check_mentions(found, _lines(spark, d), "cves"), "V14").groupBy("check", "shard", "id").agg(F.count("*").alias("n"))


@query(f"WITH {_M} SELECT 'V15' AS \"check\", substr(cve, 5, 4) AS shard, cve AS id, message_id AS detail FROM m WHERE doc_id % 80 = 3")
def j10_mentions_without_messages(spark, d):
    return _only(validate.check_mentions(_mentions(spark, d), _lines(spark, d).filter(_number() % 80 != 3), "cves"), "V15")


@query(f"""WITH {_M}, o AS (SELECT *, row_number() OVER (PARTITION BY cve ORDER BY ts) AS place FROM m) SELECT 'V15' AS "check", substr(cve, 5, 4) AS shard, cve AS id, '0' AS detail FROM o WHERE doc_id % 30 = 11 AND place > 1""")
def v15_mention_order(spark, d):
    found = _mentions(spark, d).withColumn("date", F.when(_number() % 30 == 11, "0").otherwise(F.col("date")))
    return _only(validate.check_mentions(found, _lines(spark, d), "cves"), "V15")


@query(f"WITH {_M} SELECT 'V17' AS \"check\", 'right' AS shard, ghsa AS id, message_id AS detail FROM m WHERE doc_id % 21 = 0 UNION ALL SELECT 'V17', 'left', ghsa, message_id FROM m WHERE doc_id % 21 = 14")
def j11_membership_both_ways(spark, d):
    messages = _lines(spark, d).withColumn("ghsa_ids", F.when(_number() % 21 == 14, F.array().cast("array<string>")).otherwise(F.col("ghsa_ids")))
    return _only(validate.check_mentions(_mentions(spark, d, "ghsas").filter(_number() % 21 != 0), messages, "ghsas"), "V17")


@query(f"""{_SHARDS} SELECT 'V2-V4' AS "check", shard, kind AS id, CASE kind WHEN 'messages' THEN 'count' WHEN 'bodies' THEN 'bytes' WHEN 'cves' THEN 'sha256' ELSE 'not in manifest' END AS detail FROM s
UNION ALL SELECT 'V2-V4', '1066', 'cves', 'not on disk'""")
def j13_manifest_against_disk(spark, d):
    home, manifest, _ = _published(spark, d)
    told = shards.manifest_rows(spark, manifest).filter("kind <> 'ghsas'")
    damaged = told.select("kind", "shard", (F.col("count") + (F.col("kind") == "messages").cast("long")).alias("count"), F.when(F.col("kind") == "cves", "0").otherwise(F.col("sha256")).alias("sha256"), F.when(F.col("kind") == "bodies", F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"))
    more = spark.createDataFrame([("cves", "1066", 1, "0", None)], told.schema)
    return validate.check_manifest(damaged.unionByName(more), shards.measured_files(spark, home))


@query("SELECT unnest(['V1 schema', 'V1 generated_at', 'V16 ghsas is not the one shard all', 'V18 total_cves', 'V18 total_ghsas', 'V4 messages and bodies differ in number']) AS said")
def v1_manifest_itself(spark, d):
    manifest = _published(spark, d)[1]
    damaged = manifest | {"schema": 2, "generated_at": "now", "total_cves": -1, "ghsas": {}, "bodies": {}}
    return spark.createDataFrame([(x,) for x in publish.document_violations(damaged) if publish.document_violations(manifest) == []], "said string")


@query(f"""WITH {_M}, c AS (SELECT count(*) + count(*) FILTER (WHERE twice) AS stored, count(*) FILTER (WHERE doc_id % 2 = 0) + count(*) FILTER (WHERE twice AND doc_id % 2 = 0) AS seen FROM m)
SELECT CAST(1 AS BIGINT) AS n, 'V20 the log holds ' || seen || ', total_stored ' || stored AS said FROM c""")
def v20_recount(spark, d):
    report = publish.check(spark, _published(spark, d)[0], made_log(spark, d).filter("floor(seq / 2) % 2 = 0"))
    return spark.createDataFrame([(report.count, x) for x in report.first], "n long, said string")


@query("SELECT CAST(2 AS BIGINT) AS printed, CAST(5 AS BIGINT) AS found")
def o7_error_cap(spark, d):
    home = make_folder(spark, scratch(spark, "bad-index"))
    publish.put_document(spark, f"{home}/manifest.json", json.dumps({"schema": 2, "total_stored": 3, "total_messages": 4}))
    for kind, end in (("messages", "jsonl"), ("bodies", "jsonl"), ("cves", "json"), ("ghsas", "json")):
        publish.put_document(spark, f"{make_folder(spark, f'{home}/{kind}')}/none.{end}", "")
    report = publish.check(spark, home, most=2)
    return spark.createDataFrame([(len(report.first), report.count - 2)], "printed long, found long")


# ---- parsing ----


@query(f"""WITH {_M} SELECT 2 * doc_id AS seq, message_id AS mid, ts, 'date' AS date_source, 'maildir' AS provenance, 'Writer <w@x.org>' AS sender, subject, thread_root AS irt, thread_root AS refs, cve AS cves, coalesce(ghsa, '') AS ghsas, sha256(text) AS full_sha FROM m
UNION ALL SELECT 2 * doc_id + 1, message_id, CASE WHEN ts <= 1704067200 + 172800 THEN ts ELSE 1704067200 END, CASE WHEN ts <= 1704067200 + 172800 THEN 'date' ELSE 'source_url' END, 'scrape', 'Writer <w@x.org>', subject, NULL, '', cve, coalesce(ghsa, ''), sha256(text || chr(10) || 'footer') FROM m WHERE twice""")
def p1_parsed_messages(spark, d):
    joined = lambda c: F.array_join(c, ",")
    return index.parse(made_log(spark, d), Profile()).select("seq", "mid", "ts", "date_source", "provenance", F.col("from").alias("sender"), "subject", "irt", joined("refs").alias("refs"), joined("cve_ids").alias("cves"), joined("ghsa_ids").alias("ghsas"), "full_sha")


def _dated(spark: SparkSession, d: str) -> DataFrame:
    """Mail of orders: of four, one with a date, one far ahead, one with the list's Received header alone, one with nothing."""
    k = F.col("o_orderkey") % 4
    at = lambda c, zone: F.concat(F.date_format(c, "d MMM yyyy HH:mm:ss"), F.lit(zone))
    ahead = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + 864_000)
    hop = F.concat(F.lit("Received: from mx.org by box.sub.org; Mon, 1 Jan 2001 00:00:00 +0000\nReceived: from a.org by mail1.hop.net\n with SMTP; "), at("o_orderdate", " -0100"), F.lit("\n"))
    head = F.concat(F.when(k != 3, hop).otherwise(""), F.when(k == 0, F.concat(F.lit("Date: "), at("o_orderdate", " +0200"), F.lit("\n"))).when(k == 1, F.concat(F.lit("Date: "), at(ahead, " +0000"), F.lit("\n"))).otherwise(""))
    raw = F.concat(head, F.lit("Message-ID: <"), F.col("o_orderkey").cast("string"), F.lit("@x.org>\n\nbody\n"))
    return _stored(table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), raw.alias("raw")))


@query("""SELECT o_orderkey AS seq, CASE o_orderkey % 4 WHEN 0 THEN sec - 7200 WHEN 3 THEN 32503680000 ELSE sec + 3600 END AS ts, CASE o_orderkey % 4 WHEN 0 THEN 'date' WHEN 3 THEN 'commit' ELSE 'received' END AS date_source
FROM (SELECT o_orderkey, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS sec FROM orders)""")
def x14_date_fallback(spark, d):
    return index.parse(_dated(spark, d), Profile(hop=r"mail1\.hop\.net")).select("seq", "ts", "date_source")


@query("SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 4 = 3 THEN 'commit' WHEN o_orderkey % 4 = 2 THEN 'received' WHEN o_orderkey % 4 = 0 THEN 'date' ELSE 'received' END AS date_source, CASE WHEN o_orderkey % 4 = 2 THEN 978307200 END AS ts FROM orders WHERE o_orderkey % 4 > 1")
def f4_own_hops_only(spark, d):
    # Without a pattern of own hops the topmost Received header is the evidence, whoever wrote it.
    got = index.parse(_dated(spark, d), Profile(hop=None)).filter("seq % 4 > 1")
    return got.select("seq", "date_source", F.when(F.col("seq") % 4 == 2, F.col("ts")).cast("int").alias("ts"))


@query("SELECT doc_id, 'Ünsér <u@x.org>' AS sender, 'Größe of it' AS subject, sha256(coalesce(text, '')) AS body FROM documents")
def f5_first_part_that_is_no_attachment(spark, d):
    coded = F.base64(F.encode(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("\r\n")), "UTF-8"))
    part = lambda kind, rest, body: F.concat(F.lit(f"--bb\r\nContent-Type: {kind}\r\n{rest}\r\n"), body, F.lit("\r\n"))
    head = "From: =?utf-8?q?=C3=9Cns=C3=A9r?= <u@x.org>\r\nSubject: =?iso-8859-1?q?Gr=F6=DFe?= of\r\n it\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=bb\r\n\r\n"
    raw = F.concat(F.lit(head), part("text/plain", "Content-Disposition: attachment; filename=a.txt\r\n", F.lit("not this")), part("text/html", "", F.lit("<p>nor this</p>")), part("text/plain; charset=utf-8", "Content-Transfer-Encoding: base64\r\n", coded), F.lit("--bb--\r\n"))
    got = table(spark, d, "documents").select("doc_id", mime.parse_mail(F.encode(raw, "UTF-8")).alias("m"))
    return got.select("doc_id", "m.sender", "m.subject", F.sha2(F.col("m.body").cast("binary"), 256).alias("body"))


@query("SELECT doc_id, sha256(text) AS decoded FROM documents WHERE text IS NOT NULL")
def x11_utf8_or_latin1(spark, d):
    docs = table(spark, d, "documents").filter("text is not null")
    latin = F.encode("text", "ISO-8859-1")
    whole = (F.decode(latin, "ISO-8859-1") == F.col("text")) & ~F.is_valid_utf8(latin.cast("string"))
    return docs.select("doc_id", F.sha2(text.utf8(F.when(whole, latin).otherwise(F.encode("text", "UTF-8"))).cast("binary"), 256).alias("decoded"))


@query("SELECT doc_id, 'A: 1' AS head, sha256(coalesce(text, '')) AS rest FROM documents")
def x4_head_and_body(spark, d):
    whole = F.concat(F.when(F.col("doc_id") % 2 == 0, "A: 1\r\n\r\n").otherwise("A: 1\n\n"), F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", mail.head(whole).alias("head"), F.sha2(mail.rest(whole).cast("binary"), 256).alias("rest"))


@query("SELECT doc_id, sha256(text) AS unix FROM documents WHERE text IS NOT NULL")
def x25_unix_lines(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.sha2(text.unix_lines(F.replace("text", F.lit("\n"), F.lit("\r\n"))).cast("binary"), 256).alias("unix"))


@query("SELECT event_id, 'Subject,X-' || event_type || ',Empty' AS names FROM events")
def x33_header_names(spark, d):
    block = F.concat(F.lit("Subject : spaced\n bad line\nno colon here\nX-"), "event_type", F.lit(":v\n: nameless\nEmpty:\nwith space: no"))
    return table(spark, d, "events").select("event_id", F.array_join(F.transform(mail.headers(block), lambda h: h["name"]), ",").alias("names"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Subject,X-Spam' ELSE 'Subject' END AS kept FROM orders")
def f12_strip_anywhere(spark, d):
    # Below the boundary only what is stripped anywhere goes; without a boundary what a delivery adds goes too.
    top = F.when(F.col("o_orderkey") % 2 == 0, "Received: (qmail 7 invoked by uid 5); x\n").otherwise("")
    block = F.concat(top, F.lit("Subject: s\nX-Rspamd-Score: 1\nX-Spam: 2\nx-spamd-bar: 3"))
    hs = mail.headers(block)
    names = F.filter(F.transform(mail.sanitized(hs, r"hop\.net"), lambda h: h["name"]), lambda n: n != "Received")
    edge = mail.boundary(hs, r"hop\.net")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(F.when(edge.isNotNull(), names).otherwise(F.filter(names, lambda n: ~n.startswith("X-Spam"))), ",").alias("kept"))


# ---- copies, threads, links ----


def _parsed_keys(spark: SparkSession, d: str) -> DataFrame:
    """seq, mid, provenance of made_log, written once: the sets read them several times, and mail is parsed once."""
    return materialize(index.parse(made_log(spark, d), Profile()).select("seq", "mid", "provenance"), "keys")


@query("SELECT 2 * doc_id AS seq FROM documents")
def j7_keep_set_of_parsed(spark, d):
    parsed = _parsed_keys(spark, d)
    return dedup.keep_set(parsed, F.col("provenance") == Profile().scraped).select("seq")


@query("SELECT 2 * doc_id + 1 AS seq FROM documents WHERE doc_id % 3 = 0")
def f8_scraped(spark, d):
    parsed = _parsed_keys(spark, d)
    return dedup.purge_set(parsed, F.col("provenance") == Profile().scraped).select("seq")


@query(f"WITH {_M} SELECT message_id, url FROM m WHERE twice")
def j8_spare_url(spark, d):
    return _built(spark, d).messages.filter(F.size("duplicates") > 0).select("message_id", "url")


@query(f"WITH {_M} SELECT message_id, in_reply_to FROM m")
def f6_self_reply(spark, d):
    return _built(spark, d).messages.select("message_id", "in_reply_to")


@query(f"WITH {_M} SELECT message_id, 'https://archive.example.org/list/d' || doc_id || '%40x.org/' AS by_id, 'https://archive.example.org/list/' || strftime(make_timestamp(ts * 1000000), '%Y/%m/%d') AS by_day, CAST(NULL AS VARCHAR) AS nowhere FROM m")
def x27_urls(spark, d):
    rows = _built(spark, d).messages.select("message_id", F.col("message_id").alias("mid"), "ts", F.lit(None).cast("string").alias("any_url"))
    return rows.select("message_id", index.message_url(Profile(scheme="by_id")).alias("by_id"), index.message_url(Profile()).alias("by_day"), index.message_url(Profile(scheme="none")).alias("nowhere"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    """mid, irt, refs, ts: turns reply to the one before; the first three to a message that is not there."""
    turn, conv = F.col("turn"), F.col("conv_id").cast("string")
    irt = F.when(turn > 2, F.concat_ws(".", conv, (turn - 1).cast("string"))).otherwise(F.concat(F.lit("lost"), conv))
    refs = F.when(turn % 2 == 0, F.array(F.concat(F.lit("ref"), conv))).otherwise(F.array(F.lit("")))
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat_ws(".", conv, turn.cast("string")).alias("mid"), irt.alias("irt"), refs.alias("refs"), (100 - turn).alias("ts"))


_TURNS = "t AS (SELECT conv_id, turn, conv_id || '.' || turn AS mid, CASE WHEN turn > 2 THEN conv_id || '.' || (turn - 1) ELSE 'lost' || conv_id END AS irt FROM conversations)"
_EDGES = "e AS (SELECT mid AS src, irt AS dst FROM t UNION ALL SELECT mid, 'ref' || conv_id FROM t WHERE turn % 2 = 0)"


@query(f"WITH {_TURNS}, {_EDGES} SELECT src, dst FROM e")
def g1_reply_edges(spark, d):
    return threads.reply_edges(_turns(spark, d))


@query(f"WITH {_TURNS} SELECT mid AS src, 't:' || conv_id AS dst FROM t WHERE turn % 2 = 1")
def g3_index_edges(spark, d):
    rows = _turns(spark, d)
    given = rows.select("mid", F.col("conv_id").alias("tid")).unionByName(spark.createDataFrame([("unknown", 1), (None, 2), ("x", None)], "mid string, tid long"))
    return threads.index_edges(given, rows.filter("turn % 2 = 1")).select("src", F.expr("substring(dst, 2)").alias("dst"))


@query(f"WITH {_TURNS}, {_EDGES} SELECT src, dst FROM e UNION SELECT mid, 't:' || conv_id FROM t")
def u3_edge_union(spark, d):
    rows = _turns(spark, d)
    named = threads.index_edges(rows.select("mid", F.col("conv_id").alias("tid")), rows)
    return threads.reply_edges(rows).unionByName(named).select("src", F.ltrim(F.translate("dst", "\x00", " ")).alias("dst")).distinct()


@query(f"WITH {_TURNS} SELECT mid, min(mid) OVER (PARTITION BY conv_id) AS least, CAST(count(*) OVER (PARTITION BY conv_id) AS BIGINT) AS n FROM t")
def g4_thread_members(spark, d):
    rows = _turns(spark, d)
    edges = threads.reply_edges(rows).unionByName(threads.index_edges(rows.select("mid", F.col("conv_id").alias("tid")), rows))
    labels = threads.thread_of(rows, edges)
    per = labels.groupBy("thread").agg(F.min("mid").alias("least"), F.count("*").alias("n"))
    return labels.join(per, "thread").select("mid", "least", "n")


@query(f"WITH {_TURNS}, c AS (SELECT conv_id, max(turn) FILTER (WHERE turn <= 2) AS root, max(turn) AS last FROM t GROUP BY conv_id) SELECT mid, conv_id || '.' || coalesce(root, last) AS thread_root FROM t JOIN c USING (conv_id)")
def f7_root_candidates(spark, d):
    # Times fall with the turns, so of the candidates (those whose parent is no row) the last turn is the earliest.
    rows = _turns(spark, d)
    return threads.roots(rows, rows.select("mid", F.col("conv_id").alias("thread")))


@query(f"WITH {_TURNS} SELECT mid FROM t WHERE irt IN (SELECT mid FROM t)")
def j2_parent_exists(spark, d):
    rows = _turns(spark, d)
    lost = validate.orphans(rows.select("mid", "irt"), rows.select(F.col("mid").alias("parent")), "irt", "parent")
    return validate.both_ways(rows, lost, ["mid"]).select("mid")


@query("SELECT doc_id AS mid FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def u5_unknown_ids(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("mid"), F.col("n_chars").alias("seq"))
    return dedup.unseen(docs, table(spark, d, "labels").select(F.col("doc_id").alias("mid"))).select("mid")


# ---- pages ----


def _page_rows(spark: SparkSession, d: str) -> DataFrame:
    """Pages of turns: of five, one has no pre block, one no headers, one no id, one no date, one all."""
    k, name = (F.col("conv_id") + F.col("turn")) % 5, F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    head = F.concat(F.when(k != 2, F.concat(F.lit("Message-ID: &lt;"), name, F.lit("@k.bet&gt;\n"))).otherwise(""), F.when(k != 3, "Date: Mon, 1 Jan 2024 00:00:00 +0000\n").otherwise(""), F.lit('From: <a href="x">A &amp; B</a>\n'))
    inner = F.when(k == 1, "just words").otherwise(F.concat(head, F.lit("\nfirst &lt;line&gt;\n"), name))
    html = F.when(k == 0, "<p>error</p>").otherwise(F.concat(F.lit("<html><PRE style='x'>\n"), inner, F.lit("</pre></html>")))
    url = F.concat(F.lit("https://archive.example.org/list/2024/02/03/"), name)
    return table(spark, d, "conversations").select(name.alias("name"), url.alias("url"), html.alias("html"))


_PAGES = "p AS (SELECT conv_id || '.' || turn AS name, (conv_id + turn) % 5 AS k FROM conversations)"
_REASON = "CASE k WHEN 0 THEN 'no-pre-block' WHEN 1 THEN 'no-headers' WHEN 2 THEN 'no-message-id' END"


@query(f"""WITH {_PAGES} SELECT name, {_REASON} AS reason, CASE WHEN k > 2 THEN name || '@x.org' END AS mid, CASE WHEN k > 2 THEN 'first <line>' || chr(10) || name END AS body,
CASE k WHEN 3 THEN 'X-Archive-Source,X-Archive-Source-URL,Message-ID,From,Date,X-Archive-Synthesized-Date,Content-Type' WHEN 4 THEN 'X-Archive-Source,X-Archive-Source-URL,Message-ID,Date,From,Content-Type' END AS names,
CASE k WHEN 3 THEN 'Sat, 03 Feb 2024 12:00:00 +0000' WHEN 4 THEN 'Mon, 1 Jan 2024 00:00:00 +0000' END AS dated, CASE WHEN k > 2 THEN 'A & B' END AS sender FROM p""")
def s8_page_messages(spark, d):
    got = pages.page_messages(_page_rows(spark, d))
    return got.select("name", "reason", F.col("mid"), "body", F.array_join(F.transform("headers", lambda h: h["name"]), ",").alias("names"), mail.value(F.col("headers"), "Date").alias("dated"), mail.value(F.col("headers"), "From").alias("sender"))


@query(f"WITH {_PAGES} SELECT name, CASE WHEN k = 4 THEN 'diff-skip-known' ELSE {_REASON} END AS reason FROM p WHERE k <> 3")
def j5_quarantined_pages(spark, d):
    parsed = pages.page_messages(_page_rows(spark, d))
    known = parsed.filter("reason is null and not date_made").select("mid")
    return pages.quarantine(parsed, known).select("name", "reason")


@query(f"WITH {_PAGES} SELECT CASE WHEN k = 4 THEN 'eml' ELSE 'html' END AS suffix, CAST(count(*) AS BIGINT) AS n FROM p WHERE k <> 3 GROUP BY 1")
def k11_files_set_aside(spark, d):
    parsed = pages.page_messages(_page_rows(spark, d))
    known = parsed.filter("reason is null and not date_made").select("mid")
    bad = pages.quarantine(parsed, known)
    folder = make_folder(spark, scratch(spark, "aside"))
    logs.set_aside(bad.select(F.concat("name", F.when(F.col("reason") == "diff-skip-known", ".eml").otherwise(".html")).alias("name"), F.encode("html", "UTF-8").alias("content")), folder)
    return logs.quarantined(spark, folder)


@query(f"WITH {_PAGES} SELECT CASE k WHEN 3 THEN 'cur' ELSE 'new' END AS part, sha256('<p>' || name) AS raw FROM p WHERE k > 2")
def s5_mail_folders(spark, d):
    home = make_folder(spark, scratch(spark, "maildir"))
    rows = table(spark, d, "conversations").select(F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("name"), ((F.col("conv_id") + F.col("turn")) % 5).alias("k"))
    for part, own in (("cur", "k = 3"), ("new", "k = 4"), ("tmp", "k < 3")):
        logs.set_aside(rows.filter(own).select("name", F.encode(F.concat(F.lit("<p>"), "name"), "UTF-8").alias("content")), make_folder(spark, f"{home}/{part}"))
    return archive.maildir(spark, home).select(F.regexp_extract("path", r"/(cur|new|tmp)/[^/]+$", 1).alias("part"), F.sha2("raw", 256).alias("raw"))


@query("SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS links FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY l_orderkey")
def x9_index_links(spark, d):
    item = F.concat(F.lit('<LI> <a href="'), F.col("l_partkey").cast("string"), F.lit('">x</a> <a href="7">no item</a>'))
    made = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(item), "\n").alias("html"))
    return made.select("l_orderkey", F.array_join(F.transform(text.index_links(F.col("html")), lambda x: x.cast("string")), ",").alias("links"))


# ---- the log rewritten ----


def _delivered(spark: SparkSession, d: str) -> DataFrame:
    """Mail as a subscriber got it; every fourth one has nothing to strip."""
    clean = F.concat(F.lit("Received: from a by mail1.hop.net\n with SMTP; x\nSubject: s\nX-Spam-Flag: below\n\n"), F.coalesce("text", F.lit("")))
    added = F.when(F.col("doc_id") % 4 != 0, "Received: from mx by box.sub.org\n\tfor me; x\nX-Spam-Score: 5\nDKIM-Signature: a\n b\n").otherwise("")
    return _stored(table(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.concat(added, clean).alias("raw")))


_CLEAN = "'Received: from a by mail1.hop.net' || chr(10) || ' with SMTP; x' || chr(10) || 'Subject: s' || chr(10) || 'X-Spam-Flag: below' || chr(10) || chr(10) || coalesce(text, '')"


@query(f"SELECT doc_id AS seq, {_blob(_CLEAN)} AS blob, sha256({_CLEAN}) AS raw, true AS proven, 'X-Spam-Flag' AS residual FROM documents")
def k14_rewritten_log(spark, d):
    rewritten, _, _ = publish.rewrite_log(_delivered(spark, d), r"mail1\.hop\.net")
    return rewritten.select("seq", "blob", F.sha2("raw", 256).alias("raw"), "proven", F.array_join("residual", ",").alias("residual"))


@query("SELECT CAST(count(*) FILTER (WHERE doc_id % 4 <> 0) AS BIGINT) AS changed, CAST(count(*) FILTER (WHERE doc_id % 4 <> 0) * strlen('Received: from mx by box.sub.org_' || '_for me; x_' || 'X-Spam-Score: 5_' || 'DKIM-Signature: a_' || ' b_') AS BIGINT) AS bytes_removed, CAST(0 AS BIGINT) AS unproven FROM documents")
def a17_rewrite_counters(spark, d):
    return publish.rewrite_log(_delivered(spark, d), r"mail1\.hop\.net")[2]


@query("SELECT doc_id AS seq, 'kept' AS what FROM documents WHERE doc_id % 500 <> 4 UNION ALL SELECT -1, 'unmatched'")
def f16_drop_list(spark, d):
    stored = _delivered(spark, d).withColumn("blob", F.concat(F.lit("b"), F.col("seq").cast("string")))
    listed = [r["blob"] for r in stored.filter("seq % 500 = 4").select("blob").collect()]  # a list that a person wrote, of a few blobs
    rewritten, unmatched, _ = publish.rewrite_log(stored, r"mail1\.hop\.net", [*listed, "nothing"])
    return rewritten.select("seq", F.lit("kept").alias("what")).unionByName(unmatched.select(F.lit(-1).cast("long").alias("seq"), F.lit("unmatched").alias("what")))


@query("SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS unexpected FROM documents")
def t8_log_swapped(spark, d):
    rewritten = materialize(publish.rewrite_log(_delivered(spark, d), r"mail1\.hop\.net")[0], "rewritten")  # read five times
    out = f"{make_folder(spark, scratch(spark, 'log'))}/log"
    publish.replace_log(rewritten, out)
    publish.replace_log(rewritten, out)  # over the last one
    written = spark.read.parquet(out)
    return written.agg(F.count("*").alias("rows")).select("rows", F.lit(publish.unexpected_blobs(written, rewritten).count()).cast("long").alias("unexpected"))


@query("SELECT doc_id AS seq FROM documents WHERE doc_id % 9 = 1")
def j1_lost_messages(spark, d):
    stored = table(spark, d, "documents").select(F.col("doc_id").alias("seq"))
    return archive.lost_messages(stored, stored.filter("seq % 9 <> 1"))


@query("SELECT doc_id AS seq, 'c' || (doc_id % 40) AS commit, CASE WHEN doc_id % 40 < 30 THEN 'Writer ' || (doc_id % 40) END AS author FROM documents")
def j14_commit_metadata(spark, d):
    path = scratch(spark, "commits")
    record = F.concat(F.lit("c"), F.col("id").cast("string"), F.lit("\x1fWriter "), F.col("id").cast("string"), F.lit("\x1fw@x\x1fd\x1fc\x1fc@x\x1fd\x1fsubject\n"))
    spark.range(30).select(record.alias("value")).write.option("lineSep", "\x1e").text(path)
    log = table(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.concat(F.lit("c"), (F.col("doc_id") % 40).cast("string")).alias("commit"))
    return archive.with_commits(log, archive.commit_fields(spark, path)).select("seq", "commit", "author")


@query("SELECT 'c' || p_partkey AS commit, p_brand AS author, 'line one' || chr(10) || p_name AS subject FROM part")
def s15_commit_fields(spark, d):
    path = scratch(spark, "commits")
    s = lambda c: F.col(c)
    record = F.concat(F.lit("\nc"), s("p_partkey").cast("string"), F.lit("\x1f"), s("p_brand"), F.lit("\x1fm\x1fd\x1fc\x1fm\x1fd\x1fline one\n"), s("p_name"))
    table(spark, d, "part").select(record.alias("value")).write.option("lineSep", "\x1e").text(path)
    return archive.commit_fields(spark, path).select("commit", "author", "subject")


# ---- run logs ----


def _run_log(spark: SparkSession, d: str) -> DataFrame:
    """A line for each day and script: events, of which errors failed."""
    per = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd'T00:00:00Z'").alias("day"), F.concat(F.lit("run-"), (F.col("user_id") % 3).cast("string")).alias("script")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("bad"))
    text_of = lambda c: F.col(c).cast("string")
    line = F.concat_ws("\t", "day", "script", text_of("n"), (F.col("n") - F.col("bad")).cast("string"), text_of("bad"), F.lit("1"), F.when(F.col("bad") > 0, "boom").otherwise("none"))
    path = scratch(spark, "run-log")
    per.select(line.alias("value")).write.text(path)
    return archive.run_log(spark, path)


_RUNS = "r AS (SELECT strftime(ts, '%Y-%m-%dT00:00:00Z') AS day, 'run-' || (user_id % 3) AS script, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS bad FROM events GROUP BY 1, 2)"


@query(f"WITH {_RUNS} SELECT script, day, CAST(n AS BIGINT) AS total, CAST(bad AS BIGINT) AS failed FROM r")
def s14_run_log(spark, d):
    field = lambda k: F.get("fields", F.lit(k))
    return _run_log(spark, d).select("script", field(0).alias("day"), field(2).cast("long").alias("total"), field(4).cast("long").alias("failed"))


@query(f"WITH {_RUNS} SELECT max(day) AS day, CAST(arg_max(n, day) AS BIGINT) AS total FROM r WHERE script = 'run-1'")
def w7_last_line(spark, d):
    return archive.last_run(_run_log(spark, d), "run-1").select(F.get("fields", F.lit(0)).alias("day"), F.get("fields", F.lit(2)).cast("long").alias("total"))


@query(f"WITH {_RUNS}, l AS (SELECT arg_max(n - bad, day) AS imported, arg_max(bad, day) AS failed FROM r WHERE script = 'run-2') SELECT 'this' AS run, CAST(imported AS BIGINT) AS imported, CAST(failed AS BIGINT) AS failed, CASE WHEN failed > 0 THEN 'boom' END AS top FROM l UNION ALL SELECT 'older', 0, 0, NULL")
def f17_run_counters(spark, d):
    log = _run_log(spark, d)
    said = [("this", *logs.run_counters(log, "run-2", 0)), ("older", *logs.run_counters(log, "run-2", 4_000_000_000))]
    return spark.createDataFrame(said, "run string, imported long, failed long, top string")


@query(f"WITH {_RUNS} SELECT script, day, 100 * bad // n > 20 AS fails FROM r")
def f18_failure_threshold(spark, d):
    field = lambda k: F.get("fields", F.lit(k)).cast("long")
    return _run_log(spark, d).select("script", F.get("fields", F.lit(0)).alias("day"), tallies.fails(field(2), field(4), 20).alias("fails"))


def _warnings(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a run: events as warnings, residual headers, errors and noise."""
    kind = F.col("event_type")
    line = F.when(kind == "error", "SCRAPE_WARN\tdiff-skip-known\tu").when(kind == "view", F.concat(F.lit("SCRAPE_WARN\tmsg-404\t"), F.col("user_id").cast("string"))).when(kind == "click", "RESIDUAL\tX-Spam").when(kind == "signup", "Auto packing the repository").otherwise(F.concat(F.lit("bad\t"), (F.col("user_id") % 4).cast("string")))
    return table(spark, d, "events").select(line.alias("value"))


@query("""SELECT 't' AS ts, CAST(count(*) FILTER (WHERE event_type IN ('error', 'view')) AS BIGINT) AS warnings, CASE WHEN count(*) FILTER (WHERE event_type = 'view') > count(*) FILTER (WHERE event_type = 'error') THEN 'msg-404' WHEN count(*) FILTER (WHERE event_type = 'view') < count(*) FILTER (WHERE event_type = 'error') THEN 'diff-skip-known' ELSE 'msg-404' END AS top,
CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS known FROM events""")
def a10_count_if(spark, d):
    fields = logs.scrape_line("t", "scrape", "a..b", _warnings(spark, d), 4).split("\t")
    return spark.createDataFrame([(fields[0], int(fields[3]), fields[4], int(fields[6]))], "ts string, warnings long, top string, known long")


@query("""WITH b AS (SELECT 'bad ' || (user_id % 4) AS what, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'view', 'click', 'signup') GROUP BY 1)
SELECT CAST(50 AS BIGINT) AS total, CAST(38 AS BIGINT) AS imported, CAST(12 AS BIGINT) AS failed, (SELECT what FROM b ORDER BY n DESC, what DESC LIMIT 1) AS top, (SELECT CAST(max(n) AS BIGINT) FROM b) AS n""")
def a11_run_counters(spark, d):
    fields = logs.import_line("t", "import", 50, 12, _warnings(spark, d).filter("value not like 'SCRAPE%'")).split("\t")
    return spark.createDataFrame([(int(fields[2]), int(fields[3]), int(fields[4]), fields[6], int(fields[5]))], "total long, imported long, failed long, top string, n long")


@query("SELECT '2024-01-0' || k || 'T00:00:00Z' AS ts, 'import' AS script, CAST(k AS BIGINT) AS total FROM (SELECT unnest([1, 2, 3]) AS k)")
def k12_metrics_append(spark, d):
    path = scratch(spark, "metrics")
    for k in (1, 2, 3):
        logs.append_line(spark, path, f"2024-01-0{k}T00:00:00Z\timport\t{k}")
    return archive.run_log(spark, path).select(F.get("fields", F.lit(0)).alias("ts"), "script", F.get("fields", F.lit(2)).cast("long").alias("total"))


@query("""WITH b AS (SELECT 'bad' || chr(9) || (user_id % 4) AS v FROM events WHERE event_type NOT IN ('error', 'view', 'click', 'signup')) SELECT 'errors: ' || count(*) AS value, CAST(1 AS BIGINT) AS n FROM b
UNION ALL SELECT lpad(CAST(count(*) AS VARCHAR), 8, ' ') || ' ' || v, 1 FROM b GROUP BY v UNION ALL SELECT '', 1 UNION ALL SELECT v, count(*) FROM b GROUP BY v""")
def k13_error_log(spark, d):
    lines = tallies.informative(_warnings(spark, d)).filter("value not like 'SCRAPE%'")
    path = scratch(spark, "error-log")
    logs.write_report(logs.error_report(lines, None), lines, path, "errors")
    return spark.read.text(path).groupBy("value").agg(F.count("*").alias("n"))


# ---- ingest ----


@query("SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-03', INTERVAL 1 DAY)) AS DATE) AS day")
def f15_resume(spark, d):
    days = ingest.remaining_days(F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-31")), F.to_date(F.lit("2024-01-04")), reverse=True)
    return spark.range(1).select(F.explode(days).alias("day"))


@query("SELECT event_id, LEAST(CAST(floor(epoch(ts)) AS BIGINT) + 86400 * (event_id % 5), CASE WHEN event_id % 5 <= 2 THEN CAST(floor(epoch(ts)) AS BIGINT) + 86400 * (event_id % 5) ELSE CAST(floor(epoch(ts)) AS BIGINT) END) AS ts FROM events")
def t5_forged_dates(spark, d):
    rows = table(spark, d, "events").select("event_id", F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("seen"))
    rows = rows.withColumn("ts", F.timestamp_seconds(F.unix_seconds("seen") + 86400 * (F.col("event_id") % 5)))
    return ingest.plausible(rows).select("event_id", F.unix_seconds("ts").alias("ts"))


@query("SELECT doc_id AS mid, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS batch FROM documents")
def k10_log_append(spark, d):
    log = scratch(spark, "log")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("mid"), F.col("n_chars").alias("seq"))
    ingest.append_unseen(docs.filter("mid % 2 = 0"), log, batch=0)
    for _ in range(2):  # a repeated batch replaces its own rows
        ingest.append_unseen(docs, log, batch=1)
    return spark.read.parquet(log).select("mid", F.col("batch").cast("int").alias("batch"))


@query("SELECT CAST(count(DISTINCT event_id) AS BIGINT) AS imported, CAST(2 AS BIGINT) AS runs FROM events")
def t4_resume_from_checkpoint(spark, d):
    place = scratch(spark, "stream")
    shape = "mid long, seq long, ts timestamp"
    events = table(spark, d, "events").select(F.col("event_id").alias("mid"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"))
    for part in (0, 1):  # the second run takes what came since the first
        events.filter(F.col("mid") % 2 == part).write.mode("append").parquet(f"{place}/in")
        ingest.ingest(spark.readStream.schema(shape).parquet(f"{place}/in"), f"{place}/log", f"{place}/checkpoint", metrics=f"{place}/metrics").awaitTermination()
    runs = spark.read.parquet(f"{place}/metrics").filter("total > 0")
    return runs.agg(F.sum("imported").alias("imported"), F.count("*").alias("runs"))
