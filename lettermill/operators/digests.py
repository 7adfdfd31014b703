"""Digests of whole shards that no task has to hold.

Rows are hashed, rows of a block of keys are joined in order and hashed, and a shard's digest is over its
blocks' digests in order: a tree of two levels, so a list has `block` entries, or one for each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shard_digests(rows: DataFrame, shard: Column, key: str, value: Column, size: Column | None = None, block: int = 1000) -> DataFrame:
    """shard, n, bytes, digest; key is an integer that orders a shard's rows."""
    each = rows.select(shard.alias("shard"), F.floor(F.col(key) / block).alias("block"), F.col(key).alias("key"), F.sha2(value.cast("binary"), 256).alias("sha"), (F.octet_length(value.cast("binary")) if size is None else size).cast("long").alias("bytes"))
    joined = lambda order, what: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, what))), lambda x: x[what]), "\n")
    blocks = each.groupBy("shard", "block").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.sha2(joined("key", "sha").cast("binary"), 256).alias("sha"))
    return blocks.groupBy("shard").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.sha2(joined("block", "sha").cast("binary"), 256).alias("digest"))
