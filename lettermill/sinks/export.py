"""Writing an index: hashed shards, byte for byte the same on every run (K1 to K8).

One task writes one shard, in order, under a draft name that is renamed at the end, and returns its manifest
row; a repeated task writes the same bytes. Year shards of messages and bodies are sorted in the shuffle, so
a task streams its shard and holds no more than a batch of it.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill import schemas
from lettermill.functions.ids import cve_year, iso, year
from lettermill.functions.text import json_string
from lettermill.operators.mentions import mentions
from lettermill.plans.index import Index
from lettermill.session import materialize


def _list(c, of) -> F.Column:
    return F.concat(F.lit("["), F.array_join(F.transform(c, of), ","), F.lit("]"))


def _object(pairs: list[tuple[str, F.Column]]) -> F.Column:
    parts: list[F.Column] = []
    for k, (name, value) in enumerate(pairs):
        parts += [F.lit(("{" if k == 0 else ",") + f'"{name}":'), value]
    return F.concat(*parts, F.lit("}"))


def message_line() -> F.Column:
    """A message as JSON, keys in the order of the schema."""
    flag = lambda c: F.col(c).cast("string")
    copies = _list("duplicates", lambda x: _object([("blob", json_string(x["blob"])), ("provenance", json_string(x["provenance"]))]))
    special = {"synthetic_mid": flag("synthetic_mid"), "epoch": flag("epoch"), "duplicates": copies, "body_conflict": flag("body_conflict"), "cve_ids": _list("cve_ids", json_string), "ghsa_ids": _list("ghsa_ids", json_string)}
    return _object([(n, special.get(n, json_string(F.col(n)))) for n in schemas.MESSAGE.names])


def body_line() -> F.Column:
    return _object([("message_id", json_string(F.col("message_id"))), ("body", json_string(F.col("body"))), ("truncated", F.col("truncated").cast("string"))])


def mention_line() -> F.Column:
    return _object([(n, json_string(F.col(n))) for n in ("message_id", "date", "url", "thread_root")])


def put_shards(lines: DataFrame, out: str, kind: str, suffix: str, opening: str = "", joint: str = "\n", closing: str = "\n") -> DataFrame:
    """One file for each shard, streamed in the order of (ord1, ord2, ord3); its manifest rows (K6).

    lines: shard, key, line and the order columns. With keys, lines of one key are the items of its list, so
    that a list is written item by item, however long it is.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, where = fs.FileSystem.from_uri(out)
        done: list[tuple] = []
        shard = file = key = None

        def add(data: str) -> None:
            raw = data.encode()
            file.write(raw)
            state["sha"].update(raw)
            state["bytes"] += len(raw)

        def close() -> None:
            if file is not None:
                add(("]" if key is not None else "") + closing)
                file.close()
                store.move(state["draft"], f"{where}/{kind}/{shard}.{suffix}")
                done.append((kind, shard, state["count"], state["sha"].hexdigest(), state["bytes"]))

        state: dict = {}
        for batch in batches:
            for name, own, line in zip(*[batch.column(c).to_pylist() for c in ("shard", "key", "line")], strict=True):
                if name == shard and own is not None and own == key:
                    add("," + line)
                    continue
                if name != shard:
                    close()
                    shard = name
                    state = {"sha": hashlib.sha256(), "bytes": 0, "count": 0, "draft": f"{where}/{kind}/.{uuid.uuid4().hex}"}
                    file = store.open_output_stream(state["draft"])
                    add(opening)
                elif state["count"]:
                    add(("]" if key is not None else "") + joint)
                key = own
                add(line if key is None else f"{key}:[{line}")
                state["count"] += 1
        close()
        cols = list(zip(*done, strict=True)) or [[]] * 5
        types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=schemas.MANIFEST.names)

    sorted_lines = lines.repartition("shard").sortWithinPartitions("shard", "ord1", "ord2", "ord3").select("shard", "key", "line")
    return sorted_lines.mapInArrow(run, schemas.MANIFEST)


def _fs(spark: SparkSession, path: str):
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), home


def put_document(spark: SparkSession, path: str, content: str) -> None:
    """A small document under a draft name, then renamed over the old one in one step."""
    fs, target = _fs(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(content.encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    where = fs.makeQualified(target)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(draft), where, over)


def export(index: Index, out: str, source: str, built_from: dict[str, str] | None = None, generated_at: int | None = None) -> dict:
    """Write all shards and the manifest below `out` (a URI); returns the manifest (K1 to K7)."""
    spark = index.messages.sparkSession
    for kind in ("messages", "bodies", "cves", "ghsas"):
        fs, home = _fs(spark, f"{out}/{kind}")
        fs.mkdirs(home)
    plain = [year(F.col("ts")).alias("shard"), F.lit(None).cast("string").alias("key"), F.lit("").alias("ord1"), F.col("ts").alias("ord2"), F.col("message_id").alias("ord3")]
    parts = [
        put_shards(index.messages.select(*plain, message_line().alias("line")), out, "messages", "jsonl"),
        put_shards(index.bodies.select(*plain, body_line().alias("line")), out, "bodies", "jsonl"),
    ]
    for kind, column, of in (("cves", "cve_ids", cve_year(F.col("id"))), ("ghsas", "ghsa_ids", F.lit("all"))):
        found = mentions(index.messages, column, ["message_id", "date", "url", "thread_root", "ts"])
        rows = found.select(of.alias("shard"), json_string(F.col("id")).alias("key"), F.col("id").alias("ord1"), F.col("ts").alias("ord2"), F.col("message_id").alias("ord3"), mention_line().alias("line"))
        parts.append(put_shards(rows, out, kind, "json", "{\n", ",\n", "\n}\n"))
    wrote = materialize(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), "manifest")
    manifest: dict = {"schema": schemas.SCHEMA_VERSION, "source": source, "generated_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(generated_at)), "built_from": built_from or {}}
    rows = wrote.orderBy("kind", "shard").collect()  # a row for each shard
    if not any(r["kind"] == "ghsas" for r in rows):
        empty = "{\n}\n"
        put_document(spark, f"{out}/ghsas/all.json", empty)
        rows.append(spark.createDataFrame([("ghsas", "all", 0, hashlib.sha256(empty.encode()).hexdigest(), len(empty))], schemas.MANIFEST).first())
    for kind in ("messages", "cves", "ghsas", "bodies"):
        keys = ("count", "bytes", "sha256") if kind == "bodies" else ("count", "sha256")
        manifest[kind] = {r["shard"]: {k: r[k] for k in keys} for r in rows if r["kind"] == kind}
    total = lambda kind: sum(x["count"] for x in manifest[kind].values())
    manifest |= {"total_messages": total("messages"), "total_stored": index.stored, "total_cves": total("cves"), "total_ghsas": total("ghsas")}
    remove_stale(spark, out, manifest)
    put_document(spark, f"{out}/manifest.json", manifest_text(manifest))
    return manifest


def remove_stale(spark: SparkSession, out: str, manifest: dict) -> list[str]:
    """Delete shards that the manifest does not name; an index is a projection and keeps nothing (K7)."""
    gone = []
    for kind in ("messages", "bodies", "cves", "ghsas"):
        fs, home = _fs(spark, f"{out}/{kind}")
        for status in fs.listStatus(home):
            name = status.getPath().getName()
            stem = name.partition(".")[0]
            if (stem == "all" or (len(stem) == 4 and stem.isdigit())) and stem not in manifest[kind]:
                fs.delete(status.getPath(), False)
                gone.append(f"{kind}/{name}")
    return gone


def manifest_text(manifest: dict) -> str:
    """The manifest, a line for each shard."""
    lines = []
    for key, value in manifest.items():
        if key in ("messages", "cves", "ghsas", "bodies") and value:
            inner = ",\n".join(f"    {json.dumps(s)}: {json.dumps(value[s])}" for s in sorted(value))
            lines.append(f"  {json.dumps(key)}: {{\n{inner}\n  }}")
        else:
            lines.append(f"  {json.dumps(key)}: {json.dumps(value)}")
    return "{\n" + ",\n".join(lines) + "\n}\n"


def status_document(previous: dict, manifest: dict, ok: bool, now: int, newest: int | None, run: tuple[int, int, str | None] = (0, 0, None), started: int | None = None, error: str | None = None, system: str = "archive", interval: int = 14_400, links: dict | None = None) -> dict:
    """The health document; run: imported, failed, most frequent error."""
    imported, failed, top = run
    stamp = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(now))
    generated = manifest["generated_at"] if ok and manifest else stamp
    told = error or "index export failed"
    counts = {"messages": manifest["total_messages"], "stored": manifest["total_stored"], "duplicates": manifest["total_stored"] - manifest["total_messages"]} if ok and manifest else {k: previous.get("counts", {}).get(k) for k in ("messages", "stored", "duplicates")}
    return {
        "schema": schemas.SCHEMA_VERSION,
        "system": system,
        "generated_at": generated,
        "last_success_at": generated if ok else previous.get("last_success_at"),
        "last_run": {"status": "ok" if ok else "error", "duration_s": None if started is None else now - started, "imported": imported, "failed": failed, "top_error": top if ok else told},
        "freshness": {"expected_interval_s": interval, "source_lag_s": None if newest is None or not ok else now - newest},
        "counts": counts,
        "problems": ([] if ok else [told]) + ([f"{failed} message(s) failed ingest this run"] if failed else []),
        "links": links or {},
    }


def newest_ts(messages: DataFrame) -> int | None:
    return messages.agg(F.max("ts")).first()[0]


__all__ = ["body_line", "export", "iso", "manifest_text", "message_line", "newest_ts", "put_document", "put_shards", "remove_stale", "status_document"]
