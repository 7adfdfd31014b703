"""Incremental ingest: rolling windows, idempotent dedup, append.

Exact dedup has no horizon: each micro-batch is checked against the whole log by an anti-join, and no row is
dropped for being late, as old mail does arrive. The watermark of an ingest only reports event times. Windowed
counts do use it, so event times are made plausible first (T5): a forged date in the future would move it on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from lettermill.functions.mail import guarded_date
from lettermill.operators.dedup import unseen

LATE = "2 days"


def plausible(rows: DataFrame, ts: str = "ts", evidence: str = "seen") -> DataFrame:
    """ts no more than two days ahead of the evidence, both as timestamps."""
    return rows.withColumn(ts, F.timestamp_seconds(guarded_date(F.unix_seconds(ts), F.unix_seconds(evidence))))


def day_window(today, back: int = 1):
    """Days that a scheduled run reads again: today and `back` before it."""
    return F.sequence(F.date_sub(today, back), today)


def remaining_days(start, end, done=None, reverse: bool = False):
    """Days of a range that are still to do after a saved one."""
    days = F.sequence(start, end)
    if done is not None:
        days = F.filter(days, lambda d: (d < done) if reverse else (d > done))
    return F.reverse(days) if reverse else days


def valid_days(start, end):
    """Days of a range given as text; null unless both are dates and in order."""
    form = r"^\d{4}-\d{2}-\d{2}$"
    a, b = F.try_to_date(start, "yyyy-MM-dd"), F.try_to_date(end, "yyyy-MM-dd")
    fine = start.rlike(form) & end.rlike(form) & a.isNotNull() & b.isNotNull() & (a <= b)
    return F.when(fine, F.sequence(a, F.greatest(a, b)))


def read_log(spark: SparkSession, log: str, schema) -> DataFrame:
    """The log so far; a log not yet written is empty."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(log)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def append_unseen(arriving: DataFrame, log: str, key: str = "mid", order: str = "seq", batch: int = 0) -> None:
    """Append the rows whose key the log does not have; a repeated batch replaces its own rows."""
    spark = arriving.sparkSession
    known = read_log(spark, log, StructType([*arriving.schema.fields]).add("batch", "long")).filter(F.col("batch") != batch)
    fresh = unseen(arriving, known, key, order)
    fresh.write.mode("overwrite").option("compression", "zstd").parquet(f"{log}/batch={batch}")


def ingest(stream: DataFrame, log: str, checkpoint: str, key: str = "mid", order: str = "seq", ts: str = "ts", metrics: str | None = None) -> StreamingQuery:
    """Start a run that takes all that is available and stops."""

    def each(batch: DataFrame, number: int) -> None:
        append_unseen(batch, log, key, order, number)
        if metrics:
            spark = batch.sparkSession
            run = batch.agg(F.count("*").alias("total")).withColumn("batch", F.lit(number)).withColumn("imported", F.lit(spark.read.parquet(f"{log}/batch={number}").count()))
            run.write.mode("append").parquet(metrics)

    return stream.withWatermark(ts, LATE).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def windowed_counts(stream: DataFrame, ts: str = "ts", every: str = "1 day") -> DataFrame:
    """start, n: rows in each window, for the freshness log."""
    grouped = stream.withWatermark(ts, LATE).groupBy(F.window(ts, every))
    return grouped.agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


class Freshness(StreamingQueryListener):
    """What the progress of queries says: rows taken, and the newest event time, against the interval of runs.

    spark.streams.addListener(Freshness()); event times are those of the query's watermark column.
    """

    def __init__(self, interval: int = 14_400):
        self.interval, self.rows, self.newest = interval, 0, None

    def onQueryStarted(self, event) -> None: ...  # noqa: N802

    def onQueryIdle(self, event) -> None: ...  # noqa: N802

    def onQueryTerminated(self, event) -> None: ...  # noqa: N802

    def onQueryProgress(self, event) -> None:  # noqa: N802
        from datetime import datetime

        self.rows += event.progress.numInputRows
        if newest := event.progress.eventTime.get("max"):
            at = int(datetime.fromisoformat(newest.replace("Z", "+00:00")).timestamp())
            self.newest = max(at, self.newest or at)

    def lag(self, now: int) -> tuple[int | None, bool]:
        """Seconds since the newest event, and whether that is late."""
        behind = None if self.newest is None else now - self.newest
        return behind, behind is not None and behind > self.interval
