"""Publishing: export to a staging folder, check it, swap it in, write the health document."""

from __future__ import annotations

import json
import re
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill import schemas
from lettermill.functions.ids import from_iso
from lettermill.operators import validate
from lettermill.plans.index import build
from lettermill.profile import Profile
from lettermill.session import materialize
from lettermill.sinks.export import _fs, export, newest_ts, put_document, status_document
from lettermill.sources import shards


@dataclass
class Report:
    """Violations found: how many, and the first of them."""

    count: int
    first: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.count == 0


def document_violations(manifest: dict) -> list[str]:
    """What the manifest itself says wrong."""
    bad = []
    if manifest.get("schema") != schemas.SCHEMA_VERSION:
        bad.append("V1 schema")
    if not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", manifest.get("generated_at", "")):
        bad.append("V1 generated_at")
    if set(manifest.get("ghsas", {})) != {"all"}:
        bad.append("V16 ghsas is not the one shard all")
    for kind, total in (("messages", "total_messages"), ("cves", "total_cves"), ("ghsas", "total_ghsas")):
        if sum(x["count"] for x in manifest.get(kind, {}).values()) != manifest.get(total):
            bad.append(f"V18 {total}")
    if {k: x["count"] for k, x in manifest.get("messages", {}).items()} != {k: x["count"] for k, x in manifest.get("bodies", {}).items()}:
        bad.append("V4 messages and bodies differ in number")
    return bad


def check(spark: SparkSession, index: str, stored: DataFrame | None = None, most: int = 20) -> Report:
    """Every check of an index on disk; `stored`, the log it was built from, is counted again if given."""
    manifest = shards.read_document(spark, f"{index}/manifest.json")
    messages, bodies = shards.read_lines(spark, index, "messages"), shards.read_lines(spark, index, "bodies")
    checks = [validate.check_messages(messages), validate.check_bodies(messages, bodies)]
    checks += [validate.check_mentions(shards.read_mentions(spark, index, kind), messages, kind) for kind in ("cves", "ghsas")]
    checks.append(validate.check_manifest(shards.manifest_rows(spark, manifest), shards.measured_files(spark, index)))
    found = materialize(reduce(DataFrame.unionByName, checks), "violations")  # counted and read
    said = document_violations(manifest)
    copies = messages.agg(F.count("*") + F.coalesce(F.sum(F.size("duplicates")), F.lit(0))).first()[0]
    if copies != manifest.get("total_stored"):
        said.append(f"V19 rows and duplicates are {copies}, total_stored {manifest.get('total_stored')}")
    if stored is not None and (n := stored.count()) != manifest.get("total_stored"):
        said.append(f"V20 the log holds {n}, total_stored {manifest.get('total_stored')}")
    n = found.count()
    said += [" ".join(str(x) for x in row if x is not None) for row in found.limit(most).collect()]
    return Report(n + len(said) - min(n, most), said[:most])


def summary(spark: SparkSession, index: str) -> dict:
    """Stored, unique, duplicates, conflicts, fallback dates, ids and bytes, in one row."""
    messages = shards.read_lines(spark, index, "messages")
    manifest = shards.read_document(spark, f"{index}/manifest.json")
    row = messages.agg(F.count("*").alias("unique"), F.coalesce(F.sum(F.size("duplicates")), F.lit(0)).alias("duplicates"), F.count_if("body_conflict").alias("conflicts"), F.count_if(F.col("date_source") != "date").alias("fallback_dates"), F.max(from_iso(F.col("date"))).alias("newest")).first()
    return {"stored": manifest["total_stored"], **row.asDict(), "cves": manifest["total_cves"], "ghsas": manifest["total_ghsas"], "bytes": sum(x["bytes"] for x in manifest["bodies"].values())}


def swap(spark: SparkSession, staging: str, out: str) -> None:
    """Put a checked folder in the place of the last good one, which comes back if that fails.

    A rename that the store refuses tells so by its result only, so every result is looked at.
    """
    fs, new = _fs(spark, staging)
    _, home = _fs(spark, out)
    _, last = _fs(spark, f"{out.rstrip('/')}.last")
    if fs.exists(home):
        fs.delete(last, True)
        if not fs.rename(home, last):
            raise OSError(f"{out} cannot be moved aside")
    elif not fs.exists(last):
        fs.mkdirs(home.getParent())
    moved = False
    try:
        moved = fs.rename(new, home)
    finally:
        if not moved and fs.exists(last) and not fs.rename(last, home):
            raise OSError(f"the last good copy of {out} is at {out}.last")
    if not moved:
        raise OSError(f"{staging} cannot be moved to {out}")
    fs.delete(last, True)


def publish(stored: DataFrame, out: str, profile: Profile, thread_index: DataFrame | None = None, status: str | None = None, started: int | None = None, run: tuple = (0, 0, None), built_from: dict | None = None, **more) -> Report:
    """Build, check and only then replace the index at `out`; a failed build leaves the last good one.

    status: path of the health document, written either way.
    """
    spark = stored.sparkSession
    started = started or int(time.time())
    staging = f"{out.rstrip('/')}.next"
    fs, next_home = _fs(spark, staging)
    fs.delete(next_home, True)
    newest, manifest, report = None, {}, Report(1, ["index export failed"])
    try:
        index = build(stored, profile, thread_index)
        manifest = export(index, staging, profile.source, built_from, more.pop("generated_at", None))
        report = check(spark, staging, stored)
        newest = newest_ts(index.messages)
        if report.ok:
            swap(spark, staging, out)
    finally:
        fs.delete(next_home, True)
        if status:
            previous = shards.read_document(spark, status)
            doc = status_document(previous, manifest, report.ok, int(time.time()), newest, run, started, None if report.ok else report.first[0], system=profile.source, **more)
            put_document(spark, status, json.dumps(doc, indent=2) + "\n")
    return report


def rewrite_log(stored: DataFrame, hop: str, drop: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The log with sanitized headers and without listed blobs, the listed blobs that match nothing, and
    counters (K14, F16, A17). The rewritten log is to be written beside the old one and swapped; every row
    carries the proof that its body is the same."""
    from lettermill.functions.ids import blob_id
    from lettermill.operators.pages import raw_headers_and_body

    spark = stored.sparkSession
    listed = spark.createDataFrame([(b,) for b in drop], "blob string")
    kept = stored.join(listed, "blob", "left_anti")
    clean = raw_headers_and_body(kept, hop)
    counters = clean.agg(F.count_if(F.col("clean") != F.col("raw")).alias("changed"), F.sum(F.octet_length("raw") - F.octet_length("clean")).alias("bytes_removed"), F.count_if(~F.col("proven")).alias("unproven"))
    rewritten = clean.withColumn("raw", F.col("clean")).withColumn("blob", blob_id(F.col("clean"))).select(*stored.columns, "proven", "residual")
    return rewritten, listed.join(stored.select("blob"), "blob", "left_anti"), counters


def unexpected_blobs(written: DataFrame, rewritten: DataFrame) -> DataFrame:
    """Blobs of a written log that the rewrite did not give: none, if the swap may go on."""
    return written.select("blob").distinct().join(rewritten.select("blob").distinct(), "blob", "left_anti")


def replace_log(rewritten: DataFrame, out: str) -> int:
    """Write a rewritten log beside the old one, read it back, and swap only if no blob came that the rewrite did not give."""
    spark = rewritten.sparkSession
    staging = f"{out.rstrip('/')}.next"
    rewritten.write.mode("overwrite").option("compression", "zstd").parquet(staging)
    written = spark.read.schema(rewritten.schema).parquet(staging)
    if not unexpected_blobs(written, rewritten).isEmpty() or not written.filter("not proven").isEmpty():
        raise OSError("the rewritten log is not what the rewrite gave")
    n = written.count()
    swap(spark, staging, out)
    return n


def main(args: list[str]) -> int:
    """verify INDEX: 0 if all checks hold, 1 if not, 2 if they could not be made."""
    import sys

    if len(args) != 2 or args[0] != "verify":
        print("usage: python -m lettermill verify INDEX", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("verify").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if not shards.read_document(spark, f"{args[1]}/manifest.json"):
            print("no manifest", file=sys.stderr)
            return 2
        report = check(spark, args[1])
    except Exception as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return 2
    for line in report.first:
        print(line)
    if report.count > len(report.first):
        print(f"and {report.count - len(report.first)} more")
    return int(not report.ok)
