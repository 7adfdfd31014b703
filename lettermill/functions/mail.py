"""Mail headers as column expressions: an ordered array of (name, value), for headers repeat."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Top-level domains by which a rotated host name is told from a plain one.
REAL_TLDS = """
com org net edu gov mil int arpa
info biz name pro
io me co dev app blog shop site cloud tech online store xyz sh ai
aero coop museum jobs travel post asia cat mobi tel xxx
us uk de fr jp cn au ca ru cz nl be pl kr in br mx ar cl es it ch
se no fi dk gr pt ie il tr za ke ng tw hk sg my th vn id ph nz
at hu ro bg hr rs si sk mk mt cy is li lu al ba md lt lv ee ua by
tv cc eu bh om qa sa ae eg jo lb ma dz tn iq sy ye af pk ir
to fm gg im je ky vg mo tc
local lan internal localdomain home
""".split()

#: Headers that a subscriber's own delivery adds.
STRIP_NAMES = ("received", "received-spf", "authentication-results", "delivered-to", "x-original-to", "return-path", "dkim-signature", "dkim-filter", "x-received", "x-greylist")
STRIP_PREFIXES = ("arc-", "x-spam", "x-virus", "x-clamav", "x-amavis", "x-google", "x-gm-", "x-ms-", "x-microsoft-", "x-forefront-")
ANYWHERE_PREFIXES = ("x-rspamd-", "x-spamd-")
#: A header line, whose value ends before the line break; only LF ends a line.
HEADER = r"(?dm)^([^:\s]+)[ \t\x0B\f\r]*:[ \t\x0B\f\r]*([^\r\n]*(?:\r(?!\n)[^\r\n]*)*)"
#: Words that begin a clause of a Received header, and the list software's delivery stamp.
TRACE_WORDS = ("from", "by", "via", "with", "id", "for", ";")
QMAIL = r"(?i)^\s*\(qmail\s+\d+\s+invoked\b"
PLAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TURNED = "NOPQRSTUVWXYZABCDEFGHIJKLMnopqrstuvwxyzabcdefghijklm"


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c) with c evaluated a single time: a lambda evaluates all that it names anew for each element."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def head(raw: Column) -> Column:
    """Header part of a message."""
    return F.get(F.split(raw, r"\r?\n\r?\n", 2), F.lit(0))


def rest(raw: Column) -> Column:
    """Body part; empty if there is no blank line."""
    return F.coalesce(F.get(F.split(raw, r"\r?\n\r?\n", 2), F.lit(1)), F.lit(""))


def headers(text: Column) -> Column:
    """Headers in order, folded lines joined by one space, junk lines dropped."""
    unfolded = F.regexp_replace(text, r"\r?\n[\t ]\s*", " ")
    every = lambda x, k: F.regexp_extract_all(x, F.lit(HEADER), F.lit(k))
    return once(unfolded, lambda x: F.zip_with(every(x, 1), every(x, 2), lambda name, value: F.struct(name.alias("name"), value.alias("value"))))


def values(hs: Column, name: str) -> Column:
    """All values of a header, in order."""
    return F.transform(F.filter(hs, lambda h: F.lower(h["name"]) == name.lower()), lambda h: h["value"])


def value(hs: Column, name: str) -> Column:
    """First value of a header, or null."""
    return F.get(values(hs, name), F.lit(0))


def ids(c: Column) -> Column:
    """Message ids between angle brackets."""
    return F.regexp_extract_all(c, F.lit(r"<\s*([^<>\s]+)\s*>"), F.lit(1))


def bare_id(c: Column) -> Column:
    """A message id without brackets and white space around it."""
    return F.regexp_replace(F.regexp_replace(c, r"^[\s<]+", ""), r"[\s>]+$", "")


def message_id(hs: Column) -> Column:
    """The message's own id, the first if there are several."""
    own = value(hs, "Message-ID")
    return F.coalesce(F.get(ids(own), F.lit(0)), F.nullif(bare_id(own), F.lit("")))


def _every_id(hs: Column, name: str) -> Column:
    return F.flatten(F.transform(values(hs, name), ids))


def in_reply_to(hs: Column) -> Column:
    """Parent: the first id of In-Reply-To, else the last of References."""
    refs = _every_id(hs, "References")
    return F.coalesce(F.get(_every_id(hs, "In-Reply-To"), F.lit(0)), F.get(F.reverse(refs), F.lit(0)))


def references(hs: Column) -> Column:
    return F.array_distinct(F.concat(_every_id(hs, "References"), _every_id(hs, "In-Reply-To")))


def rot13(c: Column) -> Column:
    return F.translate(c, PLAIN, TURNED)


def plain_host(host: Column) -> Column:
    """Undo the rotation of a host name if that gives a real top-level domain and it has none yet."""
    tld = lambda h: F.lower(F.regexp_extract(h, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(tld(host).isin(REAL_TLDS), host).when(tld(rot13(host)).isin(REAL_TLDS), rot13(host)).otherwise(host)


def plain_hosts(c: Column) -> Column:
    """The same for every @host in a value: the pieces between hosts and the hosts alternate."""
    pattern = r"(?<=@)[A-Za-z0-9.\-]+"
    hosts = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), plain_host)
    pieces = F.split(c, pattern, -1)
    return F.array_join(F.zip_with(pieces, hosts, lambda p, h: F.concat(p, F.coalesce(h, F.lit("")))), "")


# ---- dates ----


def day_of_url(url: Column) -> Column:
    """Epoch seconds of the day in an archive path, /YYYY/MM/DD."""
    pattern = r"/(\d{4})/(\d\d)/(\d\d)(?:/|$)"
    said = F.concat_ws("-", *[F.regexp_extract(url, pattern, k) for k in (1, 2, 3)])
    return F.when(url.rlike(pattern), F.unix_seconds(F.try_to_timestamp(said, F.lit("yyyy-MM-dd"))))


#: Common named zones, hours from UTC.
ZONES = {"GMT": 0, "UT": 0, "UTC": 0, "Z": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
DATE = r"^(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4}) (\d{2}):(\d{2})(?::(\d{2}))? ([+-]\d{4}|(?i:" + "|".join(ZONES) + r"))[\x{85}\x{2028}\x{2029}]?$"


def mail_date(c: Column) -> Column:
    """Epoch seconds of an RFC 5322 date with a numeric or common named zone; null if it cannot be read."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", " "), r"^\s*[A-Za-z]{3,9}\s*,\s*", ""))
    bare = F.regexp_replace(bare, r"\s+", " ")

    def read(parts: Column) -> Column:
        part = lambda k: F.get(parts, F.lit(k))
        month = ((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(part(1))) + 2) / 3).cast("int").cast("string")
        clock = F.concat_ws(":", part(3), part(4), F.when(part(5) == "", "00").otherwise(part(5)))
        text = F.concat(part(2), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(part(0), 2, "0"), F.lit(" "), clock)
        zone = part(6)
        named = F.coalesce(*[F.when(F.upper(zone) == name, F.lit(hours * 3600)) for name, hours in ZONES.items()])
        shift = (F.substring(zone, 2, 2).cast("int") * 3600 + F.substring(zone, 4, 2).cast("int") * 60) * F.when(F.left(zone, F.lit(1)) == "-", F.lit(-1)).otherwise(F.lit(1))
        return F.unix_seconds(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))) - F.when(zone.rlike("^[+-]"), shift).otherwise(named)

    parts = once(bare, lambda x: F.when(x.rlike(DATE), F.split(F.regexp_replace(x, DATE, "$1,$2,$3,$4,$5,$6,$7"), ",")))
    return once(parts, read)


def guarded_date(stated: Column, evidence: Column, skew: int = 172_800) -> Column:
    """A stated time, unless it is more than two days ahead of the evidence."""
    return F.when(stated.isNotNull() & (stated <= evidence + skew), stated).otherwise(evidence)


# ---- sanitizing ----


def trace_clauses(received: Column) -> Column:
    """A Received header as (name, words): each clause from its word to the next such word."""

    def clauses(words: Column, marks: Column) -> Column:
        def clause(at: Column, k: Column) -> Column:
            end = F.coalesce(F.get(marks, k + 1), F.size(words))
            return F.struct(F.lower(F.get(words, at)).alias("name"), F.array_join(F.slice(words, at + 2, end - at - 1), " ").alias("words"))

        return F.transform(marks, clause)

    def marked(words: Column) -> Column:
        marks = F.filter(F.transform(words, lambda w, i: F.when(F.lower(w).isin(*TRACE_WORDS), i)), lambda i: i.isNotNull())
        return once(marks, lambda x: clauses(words, x))

    return once(F.split(F.trim(F.regexp_replace(received, r"\s+", " ")), " "), marked)


def _clause(clauses: Column, name: str) -> Column:
    return F.coalesce(F.get(F.filter(clauses, lambda x: x["name"] == name), F.lit(0))["words"], F.lit(""))


def trace_clause(received: Column, name: str) -> Column:
    """The first clause of a name; empty if there is none."""
    return _clause(trace_clauses(received), name)


def delivery_stamp(received: Column) -> Column:
    """Whether the list software's own delivery wrote the header."""
    return received.rlike(QMAIL)


def boundary(hs: Column, hop: str) -> Column:
    """Index of the first header that the list's own hop or an earlier one made; null if there is none."""

    def edge(h: Column, i: Column) -> Column:
        own = lambda cs, name: _clause(cs, name).rlike(f"(?i){hop}")
        at = once(trace_clauses(h["value"]), lambda cs: F.when(own(cs, "by"), i).when(own(cs, "from"), i + 1))
        return F.when(F.lower(h["name"]) == "received", F.coalesce(at, F.when(delivery_stamp(h["value"]), i)))

    return F.get(F.filter(F.transform(hs, edge), lambda x: x.isNotNull()), F.lit(0))


def _starts(name: Column, prefixes: tuple[str, ...]) -> Column:
    return name.rlike("^(?:" + "|".join(prefixes) + ")")


def added_in_delivery(name: Column) -> Column:
    """Whether a header of this (lower-case) name belongs to one subscriber's delivery."""
    return name.isin(*STRIP_NAMES) | _starts(name, STRIP_PREFIXES)


def _with_boundary(hs: Column, hop: str, use: Callable[[Column, Column], Column]) -> Column:
    """use(hs, boundary), with both evaluated once for all headers."""
    return once(hs, lambda x: once(boundary(x, hop), lambda edge: use(x, edge)))


def sanitized(hs: Column, hop: str) -> Column:
    """Headers without what a subscriber's delivery added above the boundary."""
    kept = lambda h, i, edge: ~_starts(F.lower(h["name"]), ANYWHERE_PREFIXES) & (edge.isNull() | (i >= edge) | ~added_in_delivery(F.lower(h["name"])))
    return _with_boundary(hs, hop, lambda x, edge: F.filter(x, lambda h, i: kept(h, i, edge)))


def residual(hs: Column, hop: str) -> Column:
    """Names that would have been stripped but stand below the boundary."""
    low = lambda h: F.lower(h["name"])
    left = lambda h, i, edge: (i >= edge) & added_in_delivery(low(h)) & (low(h) != "received") & ~_starts(low(h), ANYWHERE_PREFIXES)
    return _with_boundary(hs, hop, lambda x, edge: F.transform(F.filter(x, lambda h, i: left(h, i, edge)), lambda h: h["name"]))
