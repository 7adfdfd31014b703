"""Archive pages to messages: what the pre block holds, as headers and body, or a reason to set it aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.functions import mail, text

#: Headers whose host names may be rotated.
ID_HEADERS = ("message-id", "in-reply-to", "references", "resent-message-id")


def page_messages(pages: DataFrame, scraped: str = "scrape", url: str = "url", html: str = "html") -> DataFrame:
    """All columns of pages, headers, body, mid and reason (null: a message; else why it is none).

    Reasons are tried in this order: no-pre-block, no-headers, no-message-id. A message without a date gets
    noon of the day in its page's path, and says so in a header of its own.
    """
    block = F.regexp_replace(text.decode_entities(text.strip_tags(text.pre_block(F.col(html)))), r"^\r?\n", "")
    cut = pages.withColumn("_block", block).withColumns({"_head": mail.head(F.col("_block")), "_rest": mail.rest(F.col("_block"))})
    plain = F.transform(mail.headers(F.col("_head")), lambda h: F.struct(h["name"].alias("name"), F.when(F.lower(h["name"]).isin(*ID_HEADERS), mail.plain_hosts(h["value"])).otherwise(h["value"]).alias("value")))
    seen = cut.withColumn("_hs", plain)
    has = lambda n: F.exists("_hs", lambda h: F.lower(h["name"]) == n)
    header = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    day = mail.day_of_url(F.concat(F.col(url), F.lit("/")))
    made = ~has("date") & day.isNotNull()
    noon = F.date_format(F.timestamp_seconds(day + 43_200), "EEE, dd MMM yyyy HH:mm:ss '+0000'")
    optional = lambda cond, n, v: F.when(cond, F.array(header(n, v))).otherwise(F.array().cast("array<struct<name:string,value:string>>"))
    full = F.concat(
        F.array(header("X-Archive-Source", F.lit(scraped)), header("X-Archive-Source-URL", F.col(url))),
        F.col("_hs"),
        optional(made, "Date", noon),
        optional(made, "X-Archive-Synthesized-Date", F.lit("from-url")),
        optional(~has("content-type"), "Content-Type", F.lit("text/plain; charset=utf-8")),
    )
    reason = F.when(F.col("_block").isNull(), "no-pre-block").when(F.size("_hs") <= 0, "no-headers").when(~has("message-id"), "no-message-id")
    out = seen.withColumn("reason", reason)
    body = text.unix_lines(F.col("_rest"))
    kept = F.col("reason").isNull()
    return out.select(*pages.columns, F.when(kept, full).alias("headers"), F.when(kept, body).alias("body"), F.when(kept, mail.message_id(F.col("_hs"))).alias("mid"), made.alias("date_made"), "reason")


def rendered(parsed: DataFrame) -> DataFrame:
    """raw: messages as RFC 822 text, for storing."""
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"], F.lit("\n"))), "")
    whole = F.concat(lines, F.lit("\n"), F.col("body"))
    return parsed.filter("reason is null").withColumn("raw", F.encode(F.when(whole.rlike(r"(?s)\n$"), whole).otherwise(F.concat(whole, F.lit("\n"))), "UTF-8"))


def quarantine(parsed: DataFrame, known: DataFrame) -> DataFrame:
    """Pages that give no new message, each with its reason; known ones are healthy."""
    met = parsed.filter("reason is null").join(known.select("mid").distinct(), "mid", "left_semi").withColumn("reason", F.lit("diff-skip-known"))
    return parsed.filter("reason is not null").unionByName(met)


def raw_headers_and_body(stored: DataFrame, hop: str) -> DataFrame:
    """Stored raw messages with sanitized headers, body bytes untouched, and the proof of it.

    Lines keep their terminators: header blocks are cut out of the text, not rebuilt.
    """
    body_at = F.regexp_instr(F.col("_text"), F.lit(r"(?m)^\r?\n"), F.lit(0))
    cut = stored.withColumn("_text", F.decode(F.col("raw"), "ISO-8859-1")).withColumn("_at", body_at)
    head = F.when(F.col("_at") > 0, F.substring("_text", F.lit(1), F.col("_at") - 1)).otherwise(F.col("_text"))
    tail = F.when(F.col("_at") > 0, F.substring("_text", F.col("_at"), F.length("_text"))).otherwise(F.lit(""))
    blocks = F.split(head, r"(?<=\n)(?![\t ])", -1)
    parts = F.transform(blocks, lambda b: F.struct(F.regexp_extract(b, r"^([^:\s]+)\s*:", 1).alias("name"), F.regexp_extract(b, r"(?s)^[^:\s]+\s*:\s*(.*?)\s*$", 1).alias("value"), b.alias("block")))
    kept = mail.sanitized(F.col("_parts"), hop)
    out = cut.withColumns({"_parts": parts, "_tail": tail}).withColumn("_clean", F.concat(F.array_join(F.transform(kept, lambda p: p["block"]), ""), F.col("_tail")))
    clean = F.encode("_clean", "ISO-8859-1")
    proven = F.endswith("_clean", F.col("_tail")) & (F.length("_clean") <= F.length("_text"))
    return out.select(*stored.columns, clean.alias("clean"), mail.residual(F.col("_parts"), hop).alias("residual"), proven.alias("proven"))
