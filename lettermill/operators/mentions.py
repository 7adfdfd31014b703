"""The inverted index from identifiers to the messages that mention them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mentions(messages: DataFrame, ids: str, keep: list[str]) -> DataFrame:
    """A row for each identifier of each message."""
    return messages.select(F.explode(ids).alias("id"), *keep)


def first_mentions(found: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """The first mention of every identifier (W5, Q1): an aggregate that combines before the shuffle."""
    return found.groupBy("id").agg(F.min_by(F.struct(*keep), F.struct(*order)).alias("m")).select("id", *[F.col("m")[c].alias(c) for c in keep])


def inverted(found: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """id, mentions: every identifier's mentions in order (A5, K3). A list grows with its identifier's mentions."""
    entry = F.struct(F.struct(*order).alias("at"), F.struct(*keep).alias("m"))
    return found.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["m"]).alias("mentions"))
