"""The stored message log: one commit a message at path m, removals at path d, several epochs.

`spark.dataSource.register(EpochLog)`, then `spark.read.format("epoch_log").load(inbox)`: a partition for each
`COMMITS` commits of an epoch, read with `git cat-file --batch`, many blobs asked for at a time. A range that ends
before its last commit, or lacks a blob, is an error (J1). The inbox must be on a path that all executors see.
seq orders a log: epoch first, then commits from the oldest on.
"""

from __future__ import annotations

import logging
import re
import subprocess
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LOG = "seq long, epoch int, commit string, commit_ts long, path string, blob string, raw binary"
EPOCH_SHIFT = 40
FILE_SHIFT = 3  # a commit holds few files
COMMITS = 5000  # of a partition
ASKED = 512  # blobs at a time
_LINE = re.compile(r"^:\d+ \d+ [0-9a-f]+ ([0-9a-f]+) ([AM])\t([dm])$")


class Epoch(InputPartition):
    """Commits first to last (not included) of an epoch's `total` up to `tip`, counted from the oldest."""

    def __init__(self, number: int, path: str, tip: str, first: int, last: int, total: int):
        self.number, self.path, self.tip, self.first, self.last, self.total = number, path, tip, first, last, total


class EpochReader(DataSourceReader):
    def __init__(self, inbox: str, branch: str, commits: int):
        self.inbox, self.branch, self.commits = inbox, branch, commits

    def partitions(self) -> list[Epoch]:
        out = []
        for number, path in sorted((int(p.stem), p) for p in Path(self.inbox, "git").glob("*.git") if p.stem.isdigit()):
            git = lambda *a, path=path: subprocess.run(["git", "-C", str(path), *a], capture_output=True, text=True)
            if not (tip := git("rev-parse", "-q", "--verify", self.branch).stdout.strip()):
                continue  # an epoch without commits
            total = int(git("rev-list", "--count", "--first-parent", tip).stdout)  # commits that come meanwhile are for the next read
            out += [Epoch(number, str(path), tip, k, min(total, k + self.commits), total) for k in range(0, total, self.commits)]
        return out or [Epoch(0, "", "", 0, 0, 0)]

    def read(self, part: Epoch) -> Iterator[tuple]:
        if part.first == part.last:
            return
        git = ["git", "-C", part.path]
        own = [f"--skip={part.total - part.last}", f"--max-count={part.last - part.first}"]  # git counts from the newest
        log = [*git, "log", "--reverse", "--first-parent", "--raw", "--no-abbrev", "--no-renames", "--root", "--format=@%H %ct", *own, part.tip, "--"]
        with subprocess.Popen(log, stdout=subprocess.PIPE, text=True) as lines, subprocess.Popen([*git, "cat-file", "--batch"], stdin=subprocess.PIPE, stdout=subprocess.PIPE) as blobs:
            commit, ts, at, k = "", 0, part.first - 1, 0
            held: list[tuple] = []
            for line in lines.stdout:
                if line.startswith("@"):
                    commit, said = line[1:].split()
                    ts, at, k = int(said), at + 1, 0
                elif match := _LINE.match(line.rstrip("\n")):
                    blob, _, path = match.groups()
                    held.append(((part.number << EPOCH_SHIFT) + (at << FILE_SHIFT) + k, part.number, commit, ts, path, blob))
                    k += 1
                    if len(held) == ASKED:
                        yield from self._fetched(part, blobs, held)
                        held = []
            yield from self._fetched(part, blobs, held)
            blobs.stdin.close()
        if at + 1 != part.last or lines.returncode:
            raise OSError(f"{part.path}: the log ended at commit {at + 1} of {part.last}")

    def _fetched(self, part: Epoch, blobs: subprocess.Popen, held: list[tuple]) -> Iterator[tuple]:
        """Rows with their blobs, which are asked for together: what is asked fits into a pipe."""
        blobs.stdin.write(b"".join(row[5].encode() + b"\n" for row in held if row[4] == "m"))
        blobs.stdin.flush()
        for row in held:
            raw = None
            if row[4] == "m":
                head = blobs.stdout.readline().split()
                if len(head) != 3 or head[0] != row[5].encode():
                    raise OSError(f"{part.path}: no blob {row[5]}")
                raw = blobs.stdout.read(int(head[2]))
                blobs.stdout.read(1)
                if len(raw) != int(head[2]):
                    raise OSError(f"{part.path}: short read of {row[5]}")
            yield *row, raw


class EpochLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "epoch_log"

    def schema(self) -> str:
        return LOG

    def reader(self, schema) -> EpochReader:
        return EpochReader(self.options["path"], self.options.get("branch", "master"), int(self.options.get("commits", COMMITS)))


def stored_messages(spark: SparkSession, inbox: str) -> DataFrame:
    """The log without removed blobs: a removal takes every copy of its blob in its epoch (F1, F2)."""
    spark.dataSource.register(EpochLog)
    log = spark.read.format("epoch_log").load(inbox)
    gone = log.filter("path = 'd'").select("epoch", "blob").distinct()
    return log.filter("path = 'm'").drop("path").join(gone, ["epoch", "blob"], "left_anti").select("seq", "epoch", "commit", "commit_ts", "blob", "raw")


def lost_messages(stored: DataFrame, parsed: DataFrame) -> DataFrame:
    """seq of stored messages that did not come out of a step."""
    return stored.select("seq").join(parsed.select("seq"), "seq", "left_anti")


def with_commits(log: DataFrame, commits: DataFrame) -> DataFrame:
    """The log with its commits' metadata, for a replay; a commit that is not told of keeps its rows."""
    return log.join(commits, "commit", "left")


class ThreadIndex(DataSource):
    """mid, tid of the newest `xap*/over.sqlite3` below an inbox, in ranges of row numbers (S3).

    A row's data is compressed text of lines, of which the seventh is the message id. An index that cannot be read
    gives no rows: threads then follow from headers alone.
    """

    RANGE = 50_000

    @classmethod
    def name(cls) -> str:
        return "thread_index"

    def schema(self) -> str:
        return "mid string, tid long"

    def reader(self, schema):
        return ThreadIndexReader(self.options["path"])


class ThreadIndexReader(DataSourceReader):
    def __init__(self, inbox: str):
        found = sorted(Path(inbox).glob("xap*/over.sqlite3"))
        self.path = str(found[-1]) if found and found[-1].stat().st_size else ""

    def _rows(self, query: str, *values: int) -> list[tuple]:
        import sqlite3

        try:
            with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
                return db.execute(query, values).fetchall()
        except sqlite3.Error as error:
            logging.getLogger(__name__).warning("could not read %s (%s); threading from references only", self.path, error)
            return []

    def partitions(self) -> list[InputPartition]:
        top = (self._rows("SELECT max(num) FROM over") or [(None,)])[0][0] if self.path else None
        return [InputPartition(k) for k in range(1, (top or 1) + 1, ThreadIndex.RANGE)]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        import zlib

        if not self.path:
            return
        for tid, data in self._rows("SELECT tid, ddd FROM over WHERE num >= ? AND num < ?", part.value, part.value + ThreadIndex.RANGE):
            try:
                lines = zlib.decompress(data).decode("utf-8", "replace").split("\n")
            except (TypeError, zlib.error):
                continue
            if len(lines) > 6 and lines[6] and tid is not None:
                yield lines[6], tid


def thread_index(spark: SparkSession, inbox: str) -> DataFrame:
    spark.dataSource.register(ThreadIndex)
    return spark.read.format("thread_index").load(inbox)


def maildir(spark: SparkSession, path: str) -> DataFrame:
    """path, raw of the messages in cur and new; tmp is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter(F.col("path").rlike(r"/(?:cur|new)/[^/]+$")).select("path", F.col("content").alias("raw"))


def commit_fields(spark: SparkSession, path: str) -> DataFrame:
    """Commit metadata in unit-separated fields and record-separated records."""
    rows = spark.read.option("lineSep", "\x1e").text(path).filter(F.trim("value") != "")
    parts = F.split(F.regexp_replace("value", r"^\n", ""), "\x1f")
    names = ("commit", "author", "author_mail", "author_date", "committer", "committer_mail", "committer_date", "subject")
    return rows.select(*[F.get(parts, F.lit(k)).alias(n) for k, n in enumerate(names)])


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """script, line_no, fields of a run-metrics log: ragged tab-separated lines."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line_no"))
    fields = F.split("value", "\t")
    return lines.select(F.get(fields, F.lit(1)).alias("script"), "line_no", fields.alias("fields"))


def last_run(log: DataFrame, script: str) -> DataFrame:
    """fields of a script's last line: the newest, and of equal times the last (W7). A log may be a folder of files."""
    return log.filter(F.col("script") == script).agg(F.max_by("fields", F.struct(F.get("fields", F.lit(0)).alias("ts"), "line_no")).alias("fields"))


def warnings(lines: DataFrame, line: str = "value") -> DataFrame:
    """kind, category, detail of structured warning lines."""
    parts = F.split(line, "\t", 3)
    field = lambda k: F.get(parts, F.lit(k))
    return lines.filter(field(0).isin("SCRAPE_WARN", "RESIDUAL")).select(field(0).alias("kind"), field(1).alias("category"), field(2).alias("detail"))
