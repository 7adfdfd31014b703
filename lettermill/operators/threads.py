"""Threads: connected components of reply edges, and their roots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.operators.components import connected_components
from lettermill.operators.skew import join_unique


def reply_edges(copies: DataFrame, mid: str = "mid", irt: str = "irt", refs: str = "refs") -> DataFrame:
    """src, dst: each copy's id and every id it refers to; losing copies count, unknown ids too."""
    named = F.concat(F.coalesce(F.col(refs), F.array().cast("array<string>")), F.array(F.col(irt)))
    targets = F.filter(named, lambda x: x.isNotNull() & (x != ""))
    return copies.select(F.col(mid).alias("src"), F.explode(targets).alias("dst"))


def index_edges(index: DataFrame, rows: DataFrame, mid: str = "mid", tid: str = "tid") -> DataFrame:
    """src, dst: ids of known rows and the external thread ids of an index, in a name space of their own."""
    known = index.filter(f"{mid} is not null and {tid} is not null").join(rows.select(mid), mid, "left_semi")
    return known.select(F.col(mid).alias("src"), F.concat(F.lit("\x00t:"), F.col(tid).cast("string")).alias("dst"))


def thread_of(rows: DataFrame, edges: DataFrame, mid: str = "mid") -> DataFrame:
    """mid, thread: a component label for every row; nodes that are no rows connect but do not appear."""
    parts = connected_components(edges)
    return rows.select(mid).join(parts, F.col(mid) == F.col("node"), "left").select(mid, F.coalesce("component", mid).alias("thread"))


def roots(rows: DataFrame, threads: DataFrame, mid: str = "mid", irt: str = "irt", ts: str = "ts") -> DataFrame:
    """mid, thread_root: the earliest row of the thread whose parent is not a row, or the earliest if all have one."""
    parents = rows.select(F.col(mid).alias("_parent"), F.lit(True).alias("_known"))
    own = rows.select(mid, irt, ts).join(parents, F.col(irt) == F.col("_parent"), "left")
    starts = F.col(irt).isNull() | (F.col(irt) == F.col(mid)) | F.col("_known").isNull()
    placed = own.select(mid, ts, starts.alias("starts")).join(threads, mid)
    root = placed.groupBy("thread").agg(F.min_by(mid, F.struct((~F.col("starts")).alias("later"), ts, mid)).alias("thread_root"))
    return join_unique(threads, root, "thread").select(mid, "thread_root")
