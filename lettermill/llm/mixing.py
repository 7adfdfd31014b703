"""Mixing sources to target weights as a time-varying curriculum, in DataFrame functions only.

Each source gets a target number of words (water filling of the budget under caps). Its documents stand in
a fixed pseudo-random order; the mix reads that stream from its start until the target is met, at most twice
through. A weight schedule says how a source's share of the mix changes over training time t in [0, 1];
its integral is the cumulative word demand, and inverting it at a document's place in the stream gives the
document's training position. Documents are range-sorted by position.

Scale: places in a stream are prefix sums in two levels: sums by (source, hash bucket), then sums within a
bucket. The number of buckets grows with the rows, so a hot source is spread over all tasks, and equal rows
are counted before the windows. Only the table of sources (one row each) is ranked in one task.

Defined results: null text has size 0; a null source is a source of its own, ranked last; documents of size
0 and of sources with no words are taken 0 words; equal rows are told apart only by their place in the
stream; null doc_id is kept; an empty table gives no rows; extra columns are ignored. Positions are null
where nothing is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.secrets import with_text
from lettermill.session import materialize, rereadable, shuffle_width

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_EPOCHS = 2
#: Linear tilt of a source's schedule, by rank: its share of the mix starts at 1 - tilt and ends at 1 + tilt times its mean.
TILTS = (-0.5, 0.0, 0.5)
LEAST_BUCKET_ROWS = 1000
CHUNK = 4096  # copies of a row that are told apart at a time


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST_EPOCHS, tilts: tuple = TILTS) -> DataFrame:
    """source, source_size, target, tilt. Target: level * weight, at most `most` times the source's size.

    With sources by rising cap / weight, the capped ones come first; the level is what is left of the budget
    over what is left of the weight at the first source that the level does not lift over its cap.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("rank") % len(values) + 1).cast("int"))
    ranked = per.withColumn("rank", rank).withColumns({"weight": cycle(weights), "tilt": cycle(tilts), "cap": F.col("source_size") * float(most)})
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) * budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = ranked.withColumn("level", level).withColumn("free", F.col("cap") >= F.col("level") * F.col("weight"))
    at = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(whole)
    return leveled.select("source", "source_size", "tilt", F.coalesce(F.least("cap", at["level"] * F.col("weight")), F.col("cap")).alias("target"))


def training_time(share: Column, tilt: Column) -> Column:
    """The t at which the schedule's integral, t + tilt * (t^2 - t), reaches a share of the demand."""
    flat = F.lit(1.0) - tilt
    return (share * 2.0) / (flat + F.sqrt(flat * flat + tilt * share * 4.0))


def placed(sizes: DataFrame, **settings) -> DataFrame:
    """One row for each row (doc_id, source, size, copies, chunk, _row), copies told apart: taken words, first position, and place in the stream."""
    rows, chunks = sizes.agg(F.count("*"), F.max("chunk")).first()
    buckets = max(1, rows // max(LEAST_BUCKET_ROWS, math.isqrt(rows)))  # neither level of sums has a long window
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("_row").cast("string")).cast("binary"))
    grouped = sizes.withColumn("order", order).withColumn("bucket", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") * buckets / float(1 << 32)).cast("long"))
    sums = grouped.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    by_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "bucket", F.coalesce(F.sum("words").over(by_source), F.lit(0)).alias("base"))
    targets = source_targets(sizes, **settings)
    bases = bases.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select("b.source", "bucket", "base", "source_size", "tilt", "target")
    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size", "_row", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    spread = grouped.withColumn("inner", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(within), F.lit(0)))
    joined = spread.alias("d").join(bases.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket"))).select("d.doc_id", "d.source", "size", "copies", "chunk", "_row", "inner", "base", "source_size", "tilt", "target")
    if chunks:  # of a row with very many copies
        joined = joined.repartition(shuffle_width(sizes.sparkSession), "doc_id", "size", "chunk", "inner")
    each = joined.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    each = each.withColumn("start", F.col("base") + F.col("inner") + F.col("copy") * F.col("size"))
    goal = F.floor("target")
    taken = lambda epoch: F.greatest(F.lit(0), F.least("size", goal - F.col("source_size") * epoch - F.col("start")))
    each = each.withColumns({"first_pass": taken(0), "second_pass": taken(1)})
    share = F.when(F.col("first_pass") > 0, F.col("start") / F.col("target"))
    again = F.when(F.col("second_pass") > 0, (F.col("start") + F.col("source_size")) / F.col("target"))
    return each.withColumns({"taken": F.col("first_pass") + F.col("second_pass"), "position": training_time(share, F.col("tilt")), "second_position": training_time(again, F.col("tilt"))})


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and how many equal rows there are; the texts are read once."""
    sizes = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"))
    counted = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    parts = counted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK))))
    return materialize(parts.withColumn("copies", F.least(F.lit(CHUNK).cast("long"), F.col("copies") - F.col("chunk") * CHUNK)).withColumn("_row", F.lit(None).cast("long")), "sizes")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The operator: one row for each document, sorted by training position (documents left out come last)."""
    out = placed(sized(docs), **settings)
    return out.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy(F.col("position").asc_nulls_last(), "doc_id", "size")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as documents: a row for each pass over a document, cut to the words taken, by position."""
    docs = rereadable(docs)
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("doc"))
    sizes = numbered.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.source").cast("string").alias("source"), word_count(F.col("doc.text")).alias("size"), F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("chunk"), "_row")
    plan = placed(materialize(sizes, "sizes"), **settings).filter("taken > 0")
    each_pass = F.array(*[F.struct(F.col(w).alias("words"), F.col(at).alias("at")) for w, at in (("first_pass", "position"), ("second_pass", "second_position"))])
    passes = plan.select(F.col("_row").alias("_of"), F.col("doc_id").alias("_id"), "size", F.explode(each_pass).alias("p")).filter("p.words > 0").select("_of", "_id", "size", "p.words", "p.at")
    joined = numbered.join(passes, F.col("_row") == F.col("_of"))
    text = F.col("doc").getField("text")
    keep = F.col("words").cast("int")
    gaps, words = F.slice(F.split(text, WORD, -1), F.lit(1), keep), F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), keep)
    head = F.array_join(F.zip_with(gaps, words, lambda g, w: F.concat(g, w)), "")
    cut = joined.withColumn("head", F.when(F.col("words") < F.col("size"), head)).orderBy("at", "_id")
    return with_text(cut, docs, F.col("head"))
