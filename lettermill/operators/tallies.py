"""Counts over logs of warnings, errors and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Beginnings of error lines that tell nothing.
NOISE = r"^(Auto packing the repository|See \"git help gc\"|W: .* canonicalized to |no email in From:)"


def tally(rows: DataFrame, what: Column, top: int | None = None) -> DataFrame:
    """what, n: how often each occurs, most often first, ties in reverse order."""
    counted = rows.groupBy(what.alias("what")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("what"))
    return counted.limit(top) if top else counted


def top_one(rows: DataFrame, what: Column) -> DataFrame:
    """The most frequent one and its count; one row, also of no rows: none, 0."""
    best = rows.groupBy(what.alias("what")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "what")).alias("b"))
    return best.select(F.coalesce("b.what", F.lit("none")).alias("what"), F.coalesce("b.n", F.lit(0).cast("long")).alias("n"))


def informative(lines: DataFrame, line: str = "value") -> DataFrame:
    """Log lines without residual reports, known noise and blanks."""
    c = F.col(line)
    return lines.filter(~c.rlike("^RESIDUAL") & ~c.rlike(NOISE) & ~c.rlike(r"^\s*$"))


def day_counts(days: DataFrame, rows: DataFrame) -> DataFrame:
    """days_with_data, days_without, messages of a range of days."""
    per = rows.groupBy("day").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return days.join(per, "day", "left").agg(F.count_if(n > 0).alias("days_with_data"), F.count_if(n == 0).alias("days_without"), F.sum(n).alias("messages"))


def residual_headers(lines: DataFrame, line: str = "value") -> DataFrame:
    """Names of headers reported as residual."""
    fields = F.split(line, "\t")
    return lines.filter(F.get(fields, F.lit(0)) == "RESIDUAL").select(F.get(fields, F.lit(1)).alias("name"))


def fails(total: Column, failed: Column, percent: int) -> Column:
    """over_threshold as an expression."""
    return (total > 0) & (F.floor(failed * 100 / total) > percent)


def over_threshold(total: int, failed: int, percent: int | None) -> bool:
    """Whether a run fails: whole per cent of failures above the limit."""
    return percent is not None and total > 0 and 100 * failed // total > percent
