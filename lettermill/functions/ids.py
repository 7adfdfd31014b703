"""Identifiers in text: extraction, canonical forms, shard keys, content ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The identifier alphabets. What stands before is looked at only where the first letter is met.
CVE = r"(?i)(C(?<![A-Za-z0-9_]C)VE-[0-9]{4}-[0-9]{4,})(?![A-Za-z0-9_])"
GHSA = r"(?i)G(?<![A-Za-z0-9_]G)HSA((?:-[23456789cfghjmpqrvwx]{4}){3})(?![A-Za-z0-9_])"
GHSA_FORM = r"^GHSA(-[23456789cfghjmpqrvwx]{4}){3}$"


def _found(pattern: str, *texts: Column) -> Column:
    return F.concat(*[F.coalesce(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), F.array().cast("array<string>")) for t in texts])


def _set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def cve_ids(*texts: Column) -> Column:
    """CVE ids of all texts, upper case, sorted, once each; words are bounded in ASCII."""
    return _set(F.transform(_found(CVE, *texts), F.upper))


def ghsa_ids(*texts: Column) -> Column:
    """Advisory ids of all texts in canonical form."""
    return _set(F.transform(_found(GHSA, *texts), lambda x: F.concat(F.lit("GHSA"), F.lower(x))))


def cve_year(cve: Column) -> Column:
    """Shard of a CVE id: its own year, however odd."""
    return F.substring(cve, 5, 4)


def iso(ts: Column) -> Column:
    """Epoch seconds as ISO 8601 in UTC (X26); the session's time zone is UTC."""
    return F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def from_iso(c: Column) -> Column:
    """Epoch seconds of an ISO 8601 instant; null for any other form."""
    return F.when(c.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"), F.unix_seconds(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))))


def year(ts: Column) -> Column:
    """Shard of a message: its posting year in UTC."""
    return F.date_format(F.timestamp_seconds(ts), "yyyy")


def synthetic_id(source: str, date: Column, sender: Column, subject: Column, body: Column) -> Column:
    """Id of a message that has none, from its content."""
    empty = F.lit("")
    joined = F.concat_ws("\x00", F.coalesce(date, empty), F.coalesce(sender, empty), F.coalesce(subject, empty), F.coalesce(body, empty))
    return F.concat(F.left(F.sha2(joined.cast("binary"), 256), F.lit(32)), F.lit(f"@synthetic.{source}"))


def blob_id(raw: Column) -> Column:
    """Object id of a stored message."""
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(raw).cast("string")), "UTF-8"), F.unhex(F.lit("00")), raw))
