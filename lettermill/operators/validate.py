"""Integrity checks of a published index: each is a table of violations (check, shard, id, detail).

Nothing here is shared with the writer, so an error there is not repeated here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.ids import GHSA_FORM, from_iso
from lettermill.schemas import DATE_SOURCES


def violation(rows: DataFrame, check: str, bad: Column, shard: str, key: str, detail: Column) -> DataFrame:
    return rows.filter(bad).select(F.lit(check).alias("check"), F.col(shard).cast("string").alias("shard"), F.col(key).cast("string").alias("id"), detail.cast("string").alias("detail"))


def repeated_keys(rows: DataFrame, key: str, shard: str, place: list[str]) -> DataFrame:
    """key, first_place, n: keys on several rows, with where they come first."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(F.struct(shard, *place)).alias("first_place")).filter("n > 1")


def out_of_order(rows: DataFrame, within: str, by: str, order: list[str], strict: bool = True) -> DataFrame:
    """Rows whose order key does not follow the previous row's.

    The window is over one shard or one identifier, in stored order.
    """
    now, before = F.struct(*order), F.lag(F.struct(*order)).over(Window.partitionBy(within).orderBy(by))
    return rows.withColumn("_before", before).filter(F.col("_before").isNotNull() & ((now <= F.col("_before")) if strict else (now < F.col("_before")))).drop("_before")


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key no parent has."""
    return rows.join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def both_ways(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys and side: what only one of two tables has."""
    a = left.select(*keys).distinct().withColumn("_l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    met = a.join(b, keys, "full_outer")
    return met.filter("_l is null or _r is null").select(*keys, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("side"))


def check_messages(messages: DataFrame) -> DataFrame:
    """V5 to V10 over read messages: shard, row, _corrupt_record and the message columns."""
    fine = messages.filter("_corrupt_record is null and message_id is not null")
    detail = F.lit(None).cast("string")
    checks = [
        violation(messages, "V5", F.col("_corrupt_record").isNotNull() | F.col("message_id").isNull(), "shard", "row", F.col("_corrupt_record")),
        repeated_keys(fine, "message_id", "shard", ["row"]).select(F.lit("V6").alias("check"), F.col("first_place.shard").alias("shard"), F.col("message_id").alias("id"), F.col("n").cast("string").alias("detail")),
        violation(fine, "V7", F.coalesce(from_iso(F.col("date")).isNull() | (F.left("date", F.lit(4)) != F.col("shard")), F.lit(True)), "shard", "message_id", F.col("date")),
        out_of_order(fine, "shard", "row", ["date", "message_id"]).select(F.lit("V8").alias("check"), "shard", F.col("message_id").alias("id"), F.col("date").alias("detail")),
        violation(fine, "V9", F.col("duplicates").isNull() | F.col("cve_ids").isNull() | F.col("ghsa_ids").isNull() | F.col("thread_root").isNull(), "shard", "message_id", detail),
        violation(fine, "V10", ~F.coalesce(F.col("date_source").isin(*DATE_SOURCES), F.lit(False)), "shard", "message_id", F.col("date_source")),
    ]
    return reduce(DataFrame.unionByName, checks)


def placed(rows: DataFrame) -> DataFrame:
    """Rows with their place within their shard, from 1 on. What they carry is shuffled by shard: no bodies."""
    return rows.withColumn("row", F.row_number().over(Window.partitionBy("shard").orderBy("row")))


def check_bodies(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    """Bodies stand where their messages do, and have the digests these name.

    Rows of two kinds are numbered apart, so they meet by their place in the shard; bodies are hashed where they are read.
    """
    m = placed(messages.select("shard", "row", "message_id", "body_sha", F.lit(True).alias("_m")))
    b = placed(bodies.select("shard", "row", F.col("message_id").alias("_id"), F.left(F.sha2(F.col("body").cast("binary"), 256), F.lit(12)).alias("_sha"), F.lit(True).alias("_b")))
    met = m.join(b, ["shard", "row"], "full_outer")
    key = met.withColumn("id", F.coalesce("message_id", "_id"))
    both = key.filter("_m and _b")
    return reduce(
        DataFrame.unionByName,
        [
            violation(both, "V11", ~F.col("message_id").eqNullSafe(F.col("_id")), "shard", "id", F.col("_id")),
            violation(both, "V12", F.col("message_id").eqNullSafe(F.col("_id")) & (F.col("body_sha") != F.col("_sha")), "shard", "id", F.col("body_sha")),
            violation(key, "V13", F.col("_m").isNull() | F.col("_b").isNull(), "shard", "id", F.when(F.col("_m").isNull(), "body only").otherwise("message only")),
        ],
    )


def check_mentions(found: DataFrame, messages: DataFrame, kind: str) -> DataFrame:
    """V14, V15, V17 over read mentions: shard, id, pos, message_id, date; kind is "cves" or "ghsas".

    Membership is checked both ways for both kinds.
    """
    ids = "cve_ids" if kind == "cves" else "ghsa_ids"
    mine = found.select("shard", "id", "pos", "message_id", "date")
    misplaced = (F.substring("id", 5, 4) != F.col("shard")) if kind == "cves" else (~F.col("id").rlike(GHSA_FORM) | (F.col("shard") != "all"))
    named = messages.select(F.explode(ids).alias("id"), "message_id")
    sided = both_ways(mine.filter("message_id is not null"), named, ["id", "message_id"])
    checks = [
        violation(mine, "V14" if kind == "cves" else "V17", misplaced, "shard", "id", F.lit("form or shard")),
        orphans(mine, messages, "message_id", "message_id").select(F.lit("V15").alias("check"), "shard", "id", F.col("message_id").alias("detail")),
        out_of_order(mine, "id", "pos", ["date"], strict=False).select(F.lit("V15").alias("check"), "shard", "id", F.col("date").alias("detail")),
        sided.select(F.lit("V17").alias("check"), F.col("side").alias("shard"), "id", F.col("message_id").alias("detail")),
    ]
    return reduce(DataFrame.unionByName, checks)


def check_manifest(manifest: DataFrame, measured: DataFrame) -> DataFrame:
    """Shards on disk and in the manifest agree in being there, count, digest and bytes."""
    a = manifest.select("kind", "shard", *[F.col(c).alias(f"_{c}") for c in ("count", "sha256", "bytes")], F.lit(True).alias("_in"))
    met = a.join(measured.select("kind", "shard", "count", "sha256", "bytes", F.lit(True).alias("_on")), ["kind", "shard"], "full_outer")
    told = F.when(F.col("_in").isNull(), "not in manifest").when(F.col("_on").isNull(), "not on disk").when(F.col("count") != F.col("_count"), "count").when(F.col("sha256") != F.col("_sha256"), "sha256").when(F.col("_bytes").isNotNull() & (F.col("bytes") != F.col("_bytes")), "bytes")
    return met.withColumn("detail", told).filter("detail is not null").select(F.lit("V2-V4").alias("check"), "shard", F.col("kind").alias("id"), "detail")
