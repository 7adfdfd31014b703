"""Text scalars as column expressions: folding, normal forms, tags, escapes, cuts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space is spelt out: \s differs between engines in the vertical tab.
SPACE = r"[ \t\n\r\f\x0B]"
BODY_LIMIT = 262_144


def fold(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def unix_lines(c: Column) -> Column:
    """CRLF to LF."""
    return F.replace(c, F.lit("\r\n"), F.lit("\n"))


def squash_tabs(c: Column) -> Column:
    """Tabs and line breaks to spaces, so that a detail stays one field of one line."""
    return F.regexp_replace(c, r"[\t\r\n]+", " ")


def utf8(raw: Column) -> Column:
    """Bytes as text: UTF-8 where valid, else Latin-1 (X11)."""
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1"))


#: What a masked address loses, and the escape before From at the start of a line.
ADDRESS_REST = r"""@[^ \t\n\r\f\x0B<>()\[\]"',;]*"""
FROM_ESCAPE = r"(?m)^>+(?=From )"


def normal_body(c: Column) -> Column:
    """A body for comparison: addresses masked, From-escapes undone, white space folded."""
    return fold(F.regexp_replace(F.regexp_replace(c, ADDRESS_REST, "@"), FROM_ESCAPE, ""))


def bodies_differ(sha_a: Column, sha_b: Column, a: Column, b: Column) -> Column:
    """Whether two copies say different things: unequal, and neither normal form begins with the other."""
    x, y = normal_body(a), normal_body(b)
    prefix = F.when(F.octet_length(x) <= F.octet_length(y), F.startswith(y, x)).otherwise(F.startswith(x, y))
    return F.when(sha_a == sha_b, F.lit(False)).otherwise(~prefix)


def body_sha(c: Column) -> Column:
    """Cache key of a body: twelve hex digits of its SHA-256."""
    return F.left(F.sha2(c.cast("binary"), 256), F.lit(12))


def truncate(c: Column, limit: int = BODY_LIMIT) -> Column:
    """At most `limit` bytes: up to the last line break within, or else to a character's end."""
    raw = c.cast("binary")
    start = F.substring(raw, 1, limit).cast("string")
    rest = F.octet_length(F.substring_index(start, "\n", -1))  # behind the last line break
    inside = lambda k: F.substring(raw, limit + 1 - k, 1).between(F.lit(b"\x80"), F.lit(b"\xbf"))  # noqa: E731  a character goes on there
    whole = F.when(~inside(0), limit).when(~inside(1), limit - 1).when(~inside(2), limit - 2).otherwise(limit - 3)
    at = F.when(F.contains(start, F.lit("\n")), limit - rest).otherwise(whole)
    return F.when(F.octet_length(c) <= limit, c).otherwise(F.substring(raw, F.lit(1), at).cast("string"))


def json_string(c: Column) -> Column:
    """A JSON string with short escapes, other controls as \\u00xx in lower case, all else raw."""
    out = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    for symbol, escape in short.items():
        out = F.replace(out, F.lit(symbol), F.lit(escape))
    code = lambda c: F.concat(F.lit("\\u00"), F.lower(F.lpad(F.hex(F.ascii(c)), 2, "0")))
    rare = F.array_join(F.transform(F.split(out, ""), lambda c: F.when((c != "") & (c < " "), code(c)).otherwise(c)), "")
    return F.coalesce(F.concat(F.lit('"'), F.when(out.rlike(r"[\x00-\x1f]"), rare).otherwise(out), F.lit('"')), F.lit("null"))


# ---- HTML pages ----


def pre_block(html: Column) -> Column:
    """Content of the first pre element; null if there is none."""
    pattern = r"(?is)<pre\b[^>]*>(.*?)</pre>"
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, 1))


def strip_tags(c: Column) -> Column:
    """Anchors to their content, then all other tags away."""
    return F.regexp_replace(F.regexp_replace(c, r"(?is)<a\b[^>]*>(.*?)</a>", "$1"), r"(?s)<[^>]+>", "")


def index_links(html: Column) -> Column:
    """Message numbers of a day page, ascending, once each."""
    found = F.regexp_extract_all(html, F.lit(r'(?i)<li>\s*<a\s+href="(\d+)"'), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: x.cast("long"))))


@F.pandas_udf(StringType())
def decode_entities(texts: pd.Series) -> pd.Series:
    """Character references to characters."""
    import html

    return texts.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def html_text(pages: pd.Series) -> pd.Series:
    """A page as plain text, 72 columns wide (X23); the layout is this library's own."""
    import textwrap
    from html.parser import HTMLParser

    blocks = {"p", "div", "br", "li", "tr", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "hr", "article", "nav", "section", "title"}

    class Reader(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.parts: list[str] = []
            self.hidden = 0

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style")
            if tag in blocks:
                self.parts.append("\n")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style") and self.hidden > 0
            if tag in blocks:
                self.parts.append("\n")

        def handle_data(self, data):
            if not self.hidden:
                self.parts.append(data)

    def one(page: str) -> str:
        reader = Reader()
        reader.feed(page)
        reader.close()
        lines = (" ".join(x.split()) for x in "".join(reader.parts).split("\n"))
        return "\n\n".join(textwrap.fill(x, 72, break_long_words=False, break_on_hyphens=False) for x in lines if x)

    return pages.map(one, na_action="ignore")
