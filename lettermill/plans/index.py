"""From stored messages to a published index: parse, resolve copies, thread, link, write, verify.

Bodies travel only from parsing to the body shards and into the comparison of copies whose digests differ;
threading sees ids alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.functions import ids, mail, mime, text
from lettermill.operators import dedup, threads
from lettermill.operators.skew import join_unique
from lettermill.profile import Profile
from lettermill.session import materialize


def _received_date(hs, profile: Profile):
    """Time of the topmost Received header, of the list's own hops if the profile names them."""
    own = mail.values(hs, "Received")
    if profile.hop:
        own = F.filter(own, lambda r: r.rlike(rf"(?i)\bby\s+\S*{profile.hop}") | mail.delivery_stamp(r))
    dates = F.transform(own, lambda r: mail.mail_date(F.regexp_extract(r, r"(?s);\s*([^;]+?)\s*$", 1)))
    return F.get(F.filter(dates, lambda t: t > 0), F.lit(0))


def parse(stored: DataFrame, profile: Profile) -> DataFrame:
    """PARSED rows of stored messages: headers by expressions, MIME in Arrow batches."""
    hs = mail.headers(mail.head(text.utf8(F.col("raw"))))
    rows = stored.select("seq", "epoch", "blob", "commit_ts", hs.alias("hs"), mime.parse_mail("raw").alias("m"))
    stated = F.get(F.filter(F.transform(mail.values(F.col("hs"), "Date"), mail.mail_date), lambda t: t > 0), F.lit(0))
    source_url = F.nullif(text.fold(mail.value(F.col("hs"), "X-Archive-Source-URL")), F.lit(""))
    seen = rows.select("*", stated.alias("stated"), _received_date(F.col("hs"), profile).alias("received"), source_url.alias("source_url"))
    seen = seen.withColumn("url_day", mail.day_of_url(F.col("source_url")))
    evidence = F.coalesce("received", "url_day", "commit_ts")
    timely = F.col("stated").isNotNull() & (F.col("stated") <= evidence + 172_800)
    dated = seen.withColumns({
        "ts": F.when(timely, F.col("stated")).otherwise(evidence),
        "date_source": F.when(timely, "date").when(F.col("received").isNotNull(), "received").when(F.col("url_day").isNotNull(), "source_url").otherwise("commit"),
        "full_sha": F.sha2(F.col("m.body").cast("binary"), 256),
        "body": text.truncate(F.col("m.body")),
        "own": mail.message_id(F.col("hs")),
    })
    name = ids.synthetic_id(profile.source, ids.iso(F.col("ts")), F.col("m.sender"), F.col("m.subject"), F.col("body"))
    return dated.select(
        "seq", "epoch", "blob", F.coalesce("own", name).alias("mid"), F.col("own").isNull().alias("synthetic"), "ts", "date_source",
        F.col("m.sender").alias("from"), F.col("m.subject").alias("subject"), mail.in_reply_to(F.col("hs")).alias("irt"), mail.references(F.col("hs")).alias("refs"),
        F.coalesce(F.nullif(text.fold(mail.value(F.col("hs"), "X-Archive-Source")), F.lit("")), F.lit(profile.fallback_provenance)).alias("provenance"), "source_url",
        "body", (F.octet_length("m.body") > text.BODY_LIMIT).alias("truncated"), ids.cve_ids(F.coalesce("m.subject", F.lit("")), F.col("m.body")).alias("cve_ids"),
        ids.ghsa_ids(F.coalesce("m.subject", F.lit("")), F.col("m.body")).alias("ghsa_ids"), "full_sha", text.body_sha(F.col("body")).alias("body_sha"),
    )


@dataclass
class Index:
    """messages (MESSAGE columns and ts), bodies (BODY and ts), stored: number of stored messages."""

    messages: DataFrame
    bodies: DataFrame
    stored: int


def message_url(profile: Profile):
    """Permalink of a message (any_url, ts, mid) in its list's scheme."""
    if profile.scheme == "permalink":
        return F.coalesce("any_url", F.date_format(F.timestamp_seconds("ts"), profile.day_url))
    if profile.scheme == "by_id":
        return F.concat(F.lit(profile.id_url), F.url_encode("mid"), F.lit("/"))
    return F.lit(None).cast("string")


def build(stored: DataFrame, profile: Profile, thread_index: DataFrame | None = None) -> Index:
    """One row for each message id, with its duplicates, thread and links. thread_index: mid, tid."""
    parsed = materialize(parse(stored, profile).withColumn("rank", dedup.provenance_rank(F.col("provenance"), profile.ranks)), "parsed")
    light = parsed.drop("body")
    won = materialize(dedup.winners(light), "winners")
    lost = dedup.losers(light, won)
    bodies = parsed.select("mid", "seq", "body")
    # Only copies whose digest is another than the winner's have their bodies read, and their winners.
    odd = materialize(join_unique(lost.select("mid", "seq", "full_sha"), won.select("mid", F.col("full_sha").alias("_sha"), F.col("seq").alias("_seq")), "mid").filter("full_sha <> _sha"), "odd")
    pairs_won = odd.select("mid", F.col("_seq").alias("seq"), F.col("_sha").alias("full_sha")).distinct().join(bodies, ["mid", "seq"]).drop("seq")
    conflict = dedup.conflicts(pairs_won, odd.select("mid", "seq", "full_sha").join(bodies, ["mid", "seq"]))
    spare_url = lost.filter("source_url is not null").groupBy("mid").agg(F.min_by("source_url", F.struct("rank", (-F.col("seq")).alias("late"))).alias("spare_url"))
    edges = threads.reply_edges(light)
    if thread_index is not None:
        edges = edges.unionByName(threads.index_edges(thread_index, won))
    rooted = threads.roots(won, materialize(threads.thread_of(won, edges), "threads"))
    joined = won.join(rooted, "mid", "left").join(dedup.duplicate_lists(lost), "mid", "left").join(conflict, "mid", "left").join(spare_url, "mid", "left")
    joined = joined.withColumn("any_url", F.coalesce("source_url", "spare_url"))
    nothing = F.array().cast("array<struct<blob:string,provenance:string>>")
    messages = joined.select(
        F.col("mid").alias("message_id"), F.col("synthetic").alias("synthetic_mid"), "epoch", "blob", F.coalesce("duplicates", nothing).alias("duplicates"), F.coalesce("body_conflict", F.lit(False)).alias("body_conflict"),
        ids.iso(F.col("ts")).alias("date"), "date_source", "from", "subject", F.nullif("irt", "mid").alias("in_reply_to"), F.coalesce("thread_root", "mid").alias("thread_root"), message_url(profile).alias("url"), "provenance", "cve_ids", "ghsa_ids", "body_sha", "ts", "truncated", "seq",
    )
    messages = materialize(messages, "messages")
    texts = messages.select(F.col("message_id").alias("mid"), "ts", "truncated", "seq").join(bodies, ["mid", "seq"]).select(F.col("mid").alias("message_id"), "body", "truncated", "ts")
    return Index(messages.drop("truncated", "seq"), texts, parsed.count())
