"""Schemas of the archive's tables. They are part of the contract: order and names do not change."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, IntegerType, LongType, StringType, StructField, StructType

SCHEMA_VERSION = 1

TEXT, LONG, INT, FLAG, TEXTS = StringType(), LongType(), IntegerType(), BooleanType(), ArrayType(StringType())


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name.rstrip("_"), kind) for name, kind in fields.items()])


STORED = _struct(seq=LONG, epoch=INT, commit=TEXT, commit_ts=LONG, blob=TEXT, raw=BinaryType())
PARSED = _struct(
    seq=LONG, epoch=INT, blob=TEXT, mid=TEXT, synthetic=FLAG, ts=LONG, date_source=TEXT, from_=TEXT, subject=TEXT, irt=TEXT, refs=TEXTS,
    provenance=TEXT, source_url=TEXT, body=TEXT, truncated=FLAG, cve_ids=TEXTS, ghsa_ids=TEXTS, full_sha=TEXT, body_sha=TEXT,
)
MESSAGE = _struct(
    message_id=TEXT, synthetic_mid=FLAG, epoch=INT, blob=TEXT, duplicates=ArrayType(_struct(blob=TEXT, provenance=TEXT)), body_conflict=FLAG,
    date=TEXT, date_source=TEXT, from_=TEXT, subject=TEXT, in_reply_to=TEXT, thread_root=TEXT, url=TEXT, provenance=TEXT, cve_ids=TEXTS,
    ghsa_ids=TEXTS, body_sha=TEXT,
)
BODY = _struct(message_id=TEXT, body=TEXT, truncated=FLAG)
MENTION = _struct(id=TEXT, message_id=TEXT, date=TEXT, url=TEXT, thread_root=TEXT)
MANIFEST = _struct(kind=TEXT, shard=TEXT, count=LONG, sha256=TEXT, bytes=LONG)
WARNING = _struct(kind=TEXT, category=TEXT, detail=TEXT)
DATE_SOURCES = ("date", "received", "source_url", "commit")
