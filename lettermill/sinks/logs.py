"""Logs of runs: tallies with a header and the full lines, metrics lines, quarantine counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions.ids import from_iso
from lettermill.functions.text import squash_tabs
from lettermill.operators import tallies
from lettermill.sources import archive


def warning_report(lines: DataFrame, top: int | None = None) -> tuple[DataFrame, int]:
    """Categories by count, and how many warnings there are in all; nothing is to be written for none."""
    found = archive.warnings(lines).filter("kind = 'SCRAPE_WARN'")
    return tallies.tally(found, F.col("category"), top), found.count()


def error_report(lines: DataFrame, top: int | None = 10) -> DataFrame:
    """Distinct error lines by count, noise left out."""
    return tallies.tally(tallies.informative(lines), F.col("value"), top)


def import_line(ts: str, script: str, total: int, failed: int, lines: DataFrame) -> str:
    """One run as a line of seven fields."""
    best = tallies.top_one(tallies.informative(lines).select(squash_tabs(F.col("value")).alias("value")), F.col("value")).first()
    return "\t".join([ts, script, str(total), str(total - failed), str(failed), str(best["n"]), best["what"]])


def scrape_line(ts: str, script: str, days: str, lines: DataFrame, ingested: int) -> str:
    """One run as a line of eight fields: range, warnings, most frequent category and its count, known ones, new ones."""
    found = archive.warnings(lines).filter("kind = 'SCRAPE_WARN'")
    best = tallies.top_one(found, F.col("category")).first()
    counts = found.agg(F.count("*"), F.count_if(F.col("category") == "diff-skip-known")).first()
    return "\t".join([ts, script, days, str(counts[0]), best["what"], str(best["n"]), str(counts[1]), str(ingested)])


def run_counters(log: DataFrame, script: str, started: int | None = None) -> tuple[int, int, str | None]:
    """imported, failed, most frequent error of a script's last line, if it is of this run."""
    row = archive.last_run(log, script).select("fields", from_iso(F.get("fields", F.lit(0))).alias("ts")).first()
    fields, ts = row["fields"], row["ts"]
    if ts is None or (started is not None and ts < started):
        return 0, 0, None
    failed = int(fields[4])
    return int(fields[3]), failed, fields[6] if failed and len(fields) > 6 and fields[6] != "none" else None


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """suffix, n: files set aside by a run."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{eml,html}").load(path).select("path")
    return files.groupBy(F.regexp_extract("path", r"\.(\w+)$", 1).alias("suffix")).agg(F.count("*").alias("n"))


def set_aside(rows: DataFrame, folder: str) -> int:
    """Write rows (name, content) as files for a person to look at; how many there are.

    Tasks write them, under a draft name that is renamed, so a repeated task puts the same file.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, where = fs.FileSystem.from_uri(folder)
        store.create_dir(where, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with store.open_output_stream(f"{where}/{name}.draft") as f:
                    f.write(content or b"")
                store.move(f"{where}/{name}.draft", f"{where}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    safe = F.regexp_replace(F.col("name"), r"[^A-Za-z0-9._-]", "_")
    wrote = rows.select(safe.alias("name"), F.col("content").cast("binary").alias("content")).mapInArrow(run, "n long")
    return wrote.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def append_line(spark: SparkSession, log: str, line: str) -> None:
    """Add a run's line to a log that is a folder of text files."""
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(log)


def write_report(tallied: DataFrame, lines: DataFrame, path: str, title: str) -> int:
    """A header, the tally and then every line, as text; nothing is written for no lines."""
    n = lines.count()
    if n:
        counts = tallied.select(F.struct(F.lit(1).alias("part"), (-F.col("n")).alias("k"), F.col("what").cast("string").alias("s")).alias("at"), F.concat(F.lpad(F.col("n").cast("string"), 8, " "), F.lit(" "), F.col("what").cast("string")).alias("value"))
        head = lines.sparkSession.createDataFrame([(0, f"{title}: {n}"), (2, "")], "part int, value string").select(F.struct("part", F.lit(0).cast("long").alias("k"), F.lit("").alias("s")).alias("at"), "value")
        full = lines.select(F.struct(F.lit(3).alias("part"), F.monotonically_increasing_id().alias("k"), F.lit("").alias("s")).alias("at"), "value")
        head.unionByName(counts).unionByName(full).sort("at").select("value").write.mode("overwrite").text(path)
    return n
