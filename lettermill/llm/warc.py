"""WARC writing, and reading by boundary-chain verification.

Writing: each task writes the records of its rows into archives in the shared folder and returns one
manifest row per archive; only archives in the manifest count, so a lost or repeated task does no harm.

Reading: archives are cut into splits of bytes. For each split a task looks for the record magic anywhere,
also inside payloads, and emits a pair (candidate, successor) for every place whose header parses; chains
within a split are contracted at once. Pointer jumping from the start of each file then doubles the reach
over the pairs, so after log2(splits) rounds exactly the records on the chain from offset 0 are kept: magic
in a payload is never on it. Tasks read each split from its verified entry on. A header may be of any length:
what is read goes on until it ends. The records on each archive's chain must be as many as its manifest says.

Scale: a task holds one split; rounds move one row for each candidate that some chain enters a split by.

Defined results: null html is an empty payload; payloads under `DEDUP_BYTES` are all responses; of repeated
rows with the largest page_id one is the response; a null page_id is written as such and read as null
(ranked below all others, ties to the first row); null url omits the target header, line breaks in it are escaped; an empty
table gives no archives and no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.operators.skew import join_unique
from lettermill.session import make_folder, materialize, rereadable, scratch

MAGIC = b"WARC/1.0\r\n"
HEADER_BYTES = 64 << 10  # are read beyond a split at first; a header that is longer is read on
DEDUP_BYTES = 1000
FILE_BYTES = 256 << 20
SPLIT_BYTES = 16 << 20
ROW_BITS = 33  # of a row number that count within a partition
PART_BITS = 6  # so many partitions' revisits, as a power of two, are told in one folder
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

MANIFEST = "path string, bytes long, records long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def record(page: str, url: str | None, payload: bytes, length: int, digest: str, refers: str | None) -> bytes:
    """One record; a revisit keeps the HTTP head (with the full length) and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if refers is None else b"")
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {DATE}"]
    if url is not None:
        escaped = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {escaped}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def revisits_of(told: str, row: int) -> dict[int, int | None]:
    """Of the input partition that a row is in: the rows to be written as revisits, and what they refer to.

    Which rows those are is known by row number, and a row number begins with its partition's, so a task
    reads what is told of its own rows and no page is shuffled.
    """
    from pyarrow import fs, parquet

    store, where = _file_system(f"{told}/part={row >> (ROW_BITS + PART_BITS)}")
    found = store.get_file_info(fs.FileSelector(where, allow_not_found=True))
    out: dict[int, int | None] = {}
    for info in found:
        if info.base_name.endswith(".parquet") and info.base_name[0] not in "._":
            with store.open_input_file(info.path) as f:
                table = parquet.read_table(f, columns=["_row", "refers"])
            mine = {r: x for r, x in zip(table.column("_row").to_pylist(), table.column("refers").to_pylist(), strict=True) if r >> ROW_BITS == row >> ROW_BITS}
            out |= mine
    return out


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages as records; the manifest of the archives written."""
    pages = rereadable(pages)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("_row"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digests = materialize(rows.select("_row", "page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("length")), "digests")
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), F.col("page_id").alias("page_id"), (-F.col("_row")).alias("row"))
    groups = digests.filter(F.col("length") >= DEDUP_BYTES).groupBy("digest", "length").agg(F.max(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
    revisits = join_unique(digests, groups.drop("length"), "digest").filter(F.col("_row") != -F.col("first.row")).select("_row", F.col("first.page_id").alias("refers"))
    told = scratch(pages.sparkSession, "revisits")
    part = F.shiftright("_row", ROW_BITS + PART_BITS)
    revisits.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(told)
    chosen = rows.select("_row", "page_id", "url", F.octet_length("payload").cast("long").alias("length"), F.sha1("payload").alias("digest"), "payload")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, where = _file_system(folder)
        out, path, size, count, done = None, "", 0, 0, []
        again: dict[int, int | None] | None = None
        for batch in batches:
            cols = [batch.column(k) for k in ("_row", "page_id", "url", "length", "digest", "payload")]
            for k in range(batch.num_rows):
                row, page, url, length, digest, data = (c[k].as_py() for c in cols)
                if again is None:
                    again = revisits_of(told, row)
                raw = record(str(page), url, data, length, digest, str(again[row]) if row in again else None)
                if out is not None and size + len(raw) > file_bytes:
                    out.close()
                    done.append((path, size, count))
                    out = None
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc"
                    path, size, count = f"{folder}/{name}", 0, 0
                    out = store.open_output_stream(f"{where}/{name}")
                out.write(raw)
                size, count = size + len(raw), count + 1
        if out is not None:
            out.close()
            done.append((path, size, count))
        cols = list(zip(*done, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["path", "bytes", "records"])

    make_folder(pages.sparkSession, folder)
    return materialize(chosen.mapInArrow(run, MANIFEST), "archives")


# ---- reading ----


def parse_header(data: bytes, at: int) -> tuple[dict[bytes, bytes], int] | None:
    """Header fields (names in lower case) and where the block begins, or None."""
    if data[at : at + len(MAGIC)] != MAGIC:
        return None
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    fields = {}
    for line in data[at + len(MAGIC) : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not re.fullmatch(rb"\d{1,15}", fields.get(b"content-length", b"")):
        return None
    return fields, end + 4


def header_open(data: bytes, at: int) -> bool:
    """Whether the header that begins at `at` may end beyond data: no end, and no whole line that is not a field."""
    return data.find(b"\r\n\r\n", at) < 0 and all(b":" in line for line in data[at + len(MAGIC) :].split(b"\r\n")[:-1])


def read_on(f, data: bytes, at: int, left: int) -> bytes:
    """data, and what follows it in f (`left` bytes) as far as the header that begins at `at` needs."""
    more = HEADER_BYTES
    while left > 0 and header_open(data, at):
        data += (part := f.read(min(more, left)))
        if not part:
            break
        left, more = left - len(part), 2 * more
    return data


def candidate_links(data: bytes, base: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of candidates in data[: stop - base], and where each says its successor is.

    Candidates before the same end of a header share its lines, so these are looked at once: as in
    parse_header, each line must be a field, and the last Content-Length counts.
    """
    found, end, bad, sized, size = [], -1, -1, -1, b""
    at = data.find(MAGIC)
    while 0 <= at < stop - base:
        line = at + len(MAGIC)
        if end < at:
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                break
            bad, sized = -1, -1
            place = line
            for text in data[line:end].split(b"\r\n"):
                name, colon, value = text.partition(b":")
                if not colon:
                    bad = place
                elif name.strip().lower() == b"content-length":
                    sized, size = place, value.strip()
                place += len(text) + 2
        if bad < line <= sized and re.fullmatch(rb"\d{1,15}", size):
            found.append((base + at, base + end + 4 + int(size) + 4))
        at = data.find(MAGIC, at + 1)
    both = np.array(found, dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def contracted(offsets: np.ndarray, successors: np.ndarray, stop: int) -> np.ndarray:
    """Where each candidate's chain leaves the split (-1: nowhere), by pointer jumping."""
    n = len(offsets)
    at = np.searchsorted(offsets, successors)
    inside = (at < n) & (offsets[np.minimum(at, n - 1)] == successors)
    jump = np.where(inside, at, np.arange(n))
    for _ in range(max(1, n).bit_length()):
        jump = jump[jump]
    left = successors[jump]
    return np.where(left >= stop, left, -1)


def chain_records(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """How many records each candidate's chain has in the split, itself included."""
    n = len(offsets)
    at = np.searchsorted(offsets, successors)
    inside = (at < n) & (offsets[np.minimum(at, n - 1)] == successors)
    jump = np.where(inside, at, np.arange(n))
    hops = inside.astype(np.int64)
    for _ in range(max(1, n).bit_length()):
        hops, jump = hops + hops[jump], jump[jump]
    return hops + 1


def splits_of(manifest: DataFrame, split_bytes: int) -> DataFrame:
    """A row for each split of each archive, spread over the tasks."""
    cut = F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / split_bytes).cast("long"))
    each = manifest.filter("bytes > 0").select("path", "bytes", F.explode(cut).alias("split"))
    return each.select("path", "bytes", "split", (F.col("split") * split_bytes).alias("start"), F.least("bytes", (F.col("split") + 1) * split_bytes).alias("stop"))


def candidates(splits: DataFrame) -> DataFrame:
    """path, split, off, exit, records: every candidate, where its chain leaves its split, and its records there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _file_system(row["path"])
                with store.open_input_file(path) as f:
                    f.seek(row["start"])
                    data = f.read(min(row["bytes"], row["stop"] + HEADER_BYTES) - row["start"])
                    size = row["stop"] - row["start"]
                    # If any candidate's header goes on, so does the last one's.
                    if (last := data.rfind(MAGIC, 0, size - 1 + len(MAGIC))) >= 0:
                        data = read_on(f, data, last, row["bytes"] - row["start"] - len(data))
                offsets, successors = candidate_links(data, row["start"], row["stop"])
                exits = contracted(offsets, successors, row["stop"]) if len(offsets) else offsets
                records = chain_records(offsets, successors) if len(offsets) else offsets
                n = len(offsets)
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * n, pa.string()), pa.array([row["split"]] * n, pa.int64()), pa.array(offsets), pa.array(exits), pa.array(records)], names=["path", "split", "off", "exit", "records"])

    return splits.repartition("path", "split").mapInArrow(run, "path string, split long, off long, exit long, records long")


def verified_entries(found: DataFrame) -> DataFrame:
    """path, split, entry, records: where the chain from each file's start enters each split, and its records there."""
    targets = found.filter("exit >= 0").select("path", F.col("exit").alias("off")).distinct()
    entries = found.join(targets, ["path", "off"], "left_semi")
    jump = materialize(entries.select("path", "off", "exit"), "jumps")
    reach = materialize(found.filter("off = 0").select("path", "off", "exit"), "reach")
    first = True
    while True:
        # The first step leaves the start's own split; from then on every round doubles the reach.
        steps = reach.select("path", F.col("exit").alias("off")) if first else reach.alias("r").join(jump.alias("j"), ["path", "off"]).select("path", F.col("j.exit").alias("off"))
        fresh = steps.filter("off >= 0").distinct().join(reach.select("path", "off"), ["path", "off"], "left_anti")
        fresh = materialize(fresh.join(entries.select("path", "off", "exit"), ["path", "off"]).select("path", "off", "exit"), "fresh")
        if fresh.isEmpty():
            break
        reach = materialize(reach.unionByName(fresh), "reach")
        if not first:
            onward = jump.select("path", F.col("off").alias("exit"), F.col("exit").alias("next"))
            jump = materialize(jump.join(onward, ["path", "exit"]).select("path", "off", F.col("next").alias("exit")), "jumps")
        first = False
    return found.join(reach.select("path", "off"), ["path", "off"], "left_semi").groupBy("path", "split").agg(F.min("off").alias("entry"), F.min_by("records", "off").alias("records"))


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """RECORD rows of all records that the chains reach; each payload is hashed again and compared."""
    splits = splits_of(manifest, split_bytes)
    entries = materialize(verified_entries(materialize(candidates(splits), "candidates")), "entries")
    reached = entries.groupBy("path").agg(F.sum("records").alias("reached"))
    short = manifest.join(reached, "path", "left").filter(F.coalesce("reached", F.lit(0)) != F.col("records")).first()
    if short is not None:
        raise ValueError(f"{short['path']}: the number of records differs from the manifest's: {short['reached'] or 0}, not {short['records']}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _file_system(row["path"])
                out, at = [], row["entry"]
                with store.open_input_file(path) as f:
                    f.seek(at)
                    data, base = f.read(row["stop"] - at), at
                    while at < row["stop"]:
                        if len(data) - (at - base) < HEADER_BYTES and base + len(data) < row["bytes"]:  # the header may end beyond
                            data += f.read(HEADER_BYTES)
                        data = read_on(f, data, at - base, row["bytes"] - base - len(data))
                        parsed = parse_header(data, at - base)
                        if parsed is None:
                            raise ValueError(f"{row['path']}: no record at {at}")
                        fields, block = parsed
                        end = block + int(fields[b"content-length"])
                        if len(data) < end:
                            data += f.read(end - len(data))
                        out.append(read_record(fields, data[block:end]))
                        at = base + end + 4
                cols = list(zip(*out, strict=True)) or [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return splits.join(entries.drop("records"), ["path", "split"]).repartition("path", "split").mapInArrow(run, RECORD)


def _page(urn: bytes | None) -> int | None:
    said = re.fullmatch(rb"<urn:page:(-?\d+)>", urn or b"")
    return int(said[1]) if said else None


def read_record(fields: dict[bytes, bytes], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    kind = fields[b"warc-type"].decode()
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest or length")
    url = fields.get(b"warc-target-uri")
    return _page(fields.get(b"warc-record-id")), None if url is None else url.decode(), length, digest, kind, _page(fields.get(b"warc-refers-to"))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The operator: pages to archives and back."""
    return read_archives(write_archives(pages, scratch(spark, "warc")))
