"""Reading a published index: JSONL shards, identifier maps, manifest."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lettermill import schemas


def _shard() -> F.Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.jsonl?$", 1)


def read_lines(spark: SparkSession, index: str, kind: str) -> DataFrame:
    """messages or bodies with shard, row (order within the shard) and _corrupt_record; a bad line loses no other."""
    schema = schemas.MESSAGE if kind == "messages" else schemas.BODY
    with_bad = StructType([*schema.fields]).add("_corrupt_record", StringType())
    lines = spark.read.text(f"{index}/{kind}", pathGlobFilter="*.jsonl").select(_shard().alias("shard"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value")
    parsed = F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return lines.select("shard", F.col("_id").alias("row"), parsed.alias("j")).select("shard", "row", "j.*")


def read_mentions(spark: SparkSession, index: str, kind: str) -> DataFrame:
    """shard, id, pos and the mention's fields; an object's file has a line for each identifier, and lines are read apart."""
    lines = spark.read.text(f"{index}/{kind}", pathGlobFilter="*.json").select(_shard().alias("shard"), "value").filter("value like '\"%'")
    shape = "map<string,array<struct<message_id:string,date:string,url:string,thread_root:string>>>"
    one = F.concat(F.lit("{"), F.regexp_replace("value", r",\s*$", ""), F.lit("}"))
    each = lines.select("shard", F.explode(F.from_json(one, shape)).alias("id", "list"))
    return each.select("shard", "id", F.posexplode("list").alias("pos", "m")).select("shard", "id", "pos", "m.*")


def measured_files(spark: SparkSession, index: str) -> DataFrame:
    """kind, shard, count, sha256, bytes of every shard on disk, measured from the bytes, read in blocks (V3)."""
    kinds = [f"{index}/{kind}" for kind in ("messages", "bodies", "cves", "ghsas")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{json,jsonl}").load(kinds).filter(F.col("path").rlike(r"/(?:\d{4}|all)\.jsonl?$"))
    kind, shard = F.regexp_extract("path", r"/(\w+)/([^/]+)\.jsonl?$", 1), F.regexp_extract("path", r"/(\w+)/([^/]+)\.jsonl?$", 2)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                store, where = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
                sha, lines = hashlib.sha256(), 0
                with store.open_input_stream(where) as f:
                    while block := f.read(1 << 20):
                        sha.update(block)
                        lines += block.count(b"\n")
                found.append((lines, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("shard"), pa.array([n for n, _ in found], pa.int64()), pa.array([h for _, h in found], pa.string()), batch.column("bytes")], names=["kind", "shard", "lines", "sha256", "bytes"])

    names = files.select(kind.alias("kind"), shard.alias("shard"), "path", F.col("length").alias("bytes")).repartition("kind", "shard")
    seen = names.mapInArrow(measure, "kind string, shard string, lines long, sha256 string, bytes long")
    count = F.when(F.col("kind").isin("messages", "bodies"), F.col("lines")).otherwise(F.col("lines") - 2)  # an object has a line for each id, and two braces
    return seen.select("kind", "shard", count.alias("count"), "sha256", "bytes")


def read_document(spark: SparkSession, path: str) -> dict:
    """A small JSON document; a missing one is empty."""
    from py4j.protocol import Py4JError
    from pyspark.errors import AnalysisException

    try:
        return json.loads(spark.read.text(path, wholetext=True).first()[0])
    except (AnalysisException, Py4JError):
        return {}


def manifest_rows(spark: SparkSession, manifest: dict) -> DataFrame:
    rows = [(kind, shard, x["count"], x["sha256"], x.get("bytes")) for kind in ("messages", "cves", "ghsas", "bodies") for shard, x in manifest.get(kind, {}).items()]
    return spark.createDataFrame(rows, schemas.MANIFEST)


def changed_shards(old: DataFrame, new: DataFrame) -> DataFrame:
    """kind, shard, change between two manifests: what a consumer must fetch or drop (Q9)."""
    a = old.select("kind", "shard", F.col("sha256").alias("was"))
    met = a.join(new.select("kind", "shard", "sha256"), ["kind", "shard"], "full_outer").filter(~F.col("was").eqNullSafe(F.col("sha256")))
    return met.select("kind", "shard", F.when(F.col("was").isNull(), "new").when(F.col("sha256").isNull(), "gone").otherwise("changed").alias("change"))
