"""Copies of a message: one canonical row, the rest as its duplicates; keep and purge sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.functions.text import bodies_differ
from lettermill.operators.skew import join_unique


def provenance_rank(provenance: Column, ranks: tuple[str, ...]) -> Column:
    """Place of a provenance among the known ones; unknown ones come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(r) for r in ranks]), provenance), F.lit(0)), F.lit(len(ranks) + 1)).cast("int")


def winners(copies: DataFrame, key: str = "mid", rank: str = "rank", seq: str = "seq", keep: list[str] | None = None) -> DataFrame:
    """The canonical copy of each key: best rank, then latest.

    An aggregate, not a window: winners are combined before the shuffle, so a key with very many copies
    costs each task one row.
    """
    kept = keep or [c for c in copies.columns if c != key]
    best = copies.groupBy(key).agg(F.min_by(F.struct(*kept), F.struct(rank, (-F.col(seq)).alias("late"))).alias("w"))
    return best.select(key, *[F.col("w")[c].alias(c) for c in kept])


def losers(copies: DataFrame, won: DataFrame, key: str = "mid", seq: str = "seq") -> DataFrame:
    """All copies but the canonical ones."""
    return join_unique(copies, won.select(key, F.col(seq).alias("_won")), key).filter(F.col(seq) != F.col("_won")).drop("_won")


def duplicate_lists(lost: DataFrame, key: str = "mid", rank: str = "rank", seq: str = "seq", fields: tuple[str, ...] = ("blob", "provenance")) -> DataFrame:
    """key, duplicates: each key's losing copies in order of rank, then latest first (A1)."""
    entry = F.struct(F.col(rank).alias("rank"), (-F.col(seq)).alias("late"), *fields)
    ordered = F.array_sort(F.collect_list(entry))
    return lost.groupBy(key).agg(F.transform(ordered, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("duplicates"))


def conflicts(won: DataFrame, lost: DataFrame, key: str = "mid", sha: str = "full_sha", body: str = "body") -> DataFrame:
    """key, body_conflict: whether any losing copy says something else.

    Copies with an equal digest are out before bodies are read, so few bodies are compared.
    """
    pairs = join_unique(lost.select(key, sha, body), won.select(key, F.col(sha).alias("_sha"), F.col(body).alias("_body")), key).filter(F.col(sha) != F.col("_sha"))
    return pairs.groupBy(key).agg(F.bool_or(bodies_differ(F.col("_sha"), F.col(sha), F.col("_body"), F.col(body))).alias("body_conflict"))


def drop_removed(stored: DataFrame, removed: DataFrame) -> DataFrame:
    """Without every copy of a blob that its epoch marks as removed (F1)."""
    return stored.join(removed.select("epoch", "blob").distinct(), ["epoch", "blob"], "left_anti")


def keep_set(copies: DataFrame, scraped: Column, key: str = "mid") -> DataFrame:
    """All copies that are not scraped, and scraped ones whose key no other copy has."""
    full = copies.filter(~scraped)
    return full.unionByName(copies.filter(scraped).join(full.select(key).distinct(), key, "left_anti"))


def purge_set(copies: DataFrame, scraped: Column, key: str = "mid") -> DataFrame:
    """Scraped copies of keys that have both kinds."""
    both = copies.groupBy(key).agg(F.bool_or(scraped).alias("s"), F.bool_or(~scraped).alias("o")).filter("s and o").select(key)
    return copies.filter(scraped).join(both, key, "left_semi")


def census(copies: DataFrame, kind: Column, key: str = "mid") -> DataFrame:
    """pattern, keys: how many copies of which kinds the keys with several copies have.

    Kinds are counted first, so a key with very many copies is one short pattern.
    """
    each = copies.groupBy(key, kind.alias("kind")).agg(F.count("*").alias("n"))
    said = F.transform(F.array_sort(F.collect_list(F.struct("kind", "n"))), lambda x: F.concat_ws(":", x["kind"], x["n"].cast("string")))
    per = each.groupBy(key).agg(F.array_join(said, "+").alias("pattern"), F.sum("n").alias("n"))
    return per.filter("n > 1").groupBy("pattern").agg(F.count("*").alias("keys"))


def unseen(arriving: DataFrame, known: DataFrame, key: str = "mid", order: str = "seq") -> DataFrame:
    """Arriving rows whose key is not known, the first of each key."""
    fresh = arriving.join(known.select(key).distinct(), key, "left_anti")
    kept = [c for c in arriving.columns if c != key]
    return fresh.groupBy(key).agg(F.min_by(F.struct(*kept), order).alias("f")).select(key, *[F.col("f")[c].alias(c) for c in kept])
