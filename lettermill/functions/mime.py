"""MIME bodies and encoded headers, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from email import message_from_bytes
from email.message import Message

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PARSED_MAIL = StructType([StructField(name, StringType()) for name in ("sender", "subject", "body")])

#: Longer headers are left to the library.
HEAD_LIMIT = 65_536


def _decode(raw: bytes, charset: str | None) -> str:
    for name in (charset, "utf-8", "latin-1"):
        try:
            return raw.decode(name or "utf-8")
        except (LookupError, UnicodeDecodeError):
            continue
    return raw.decode("utf-8", "replace")


def _message(raw: bytes) -> Message:
    """The message of these bytes. A body that is no container is set as it stands: only headers are parsed line by line."""
    ends = [raw.find(b"\n\n") + 2, raw.find(b"\n\r\n", 0, HEAD_LIMIT) + 3]
    end = min((k for k in ends if k > 2), default=0)
    if not end or end > HEAD_LIMIT:
        return message_from_bytes(raw)
    message = message_from_bytes(raw[:end])
    if message.get_content_maintype() in ("multipart", "message") or message.get_payload():  # parts, or headers that end earlier
        return message_from_bytes(raw)
    message.set_payload(raw[end:].decode("ascii", "surrogateescape"))
    return message


def parse_one(raw: bytes) -> tuple[str | None, str | None, str]:
    """Decoded From and Subject, and the body: the first plain part that is no attachment, else the first HTML part as text."""
    from email.header import decode_header

    def header(name: str) -> str | None:
        value = message[name]
        if value is None:
            return None
        said, encoded = "", False
        for part, charset in decode_header(str(value)):
            # White space between two encoded words is no part of the value; any other is.
            said += ("" if encoded and charset else " ") + (_decode(part, charset) if isinstance(part, bytes) else part)
            encoded = charset is not None
        return " ".join(said.split())

    message = _message(raw)
    plain = page = None
    for part in message.walk():
        if part.is_multipart() or (part.get("Content-Disposition") or "").strip().lower().startswith("attachment"):
            continue
        kind = part.get_content_type()
        data = part.get_payload(decode=True) or b""
        if kind == "text/plain" and plain is None:
            plain = _decode(data, part.get_content_charset())
        elif kind in ("text/html", "text/xhtml") and page is None:
            page = _decode(data, part.get_content_charset())
    body = plain if plain is not None else (_html_text(page) if page is not None else "")
    return header("From"), header("Subject"), body.replace("\r\n", "\n")


def _html_text(page: str) -> str:
    from lettermill.functions.text import html_text

    return html_text.func(pd.Series([page]))[0]


@F.pandas_udf(PARSED_MAIL)
def parse_mail(raws: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in raws:
        yield pd.DataFrame([parse_one(x) for x in batch], columns=["sender", "subject", "body"])
