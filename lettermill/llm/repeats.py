"""Suffix-array dedup: remove what an earlier document already says, by external induced sorting.

A byte goes if some `LENGTH`-byte string over it also starts in a document with a smaller doc_id. To find
these strings exactly, each one is keyed by the least hash of its `GRAM`-byte parts: equal strings have equal
keys, and neighbouring strings mostly share one, so a run of strings with one key travels as one fragment.

1. Each task writes its documents as a shard to the shared folder and sends the keys of its strings, each
   once, to the key's bucket; a bucket answers with the keys that more than one document has.
2. For each shard, the fragments of such keys are cut, equal ones once with their least doc_id, and sent to
   buckets by key. A bucket sorts the suffixes of its distinct fragments by external induction (see `suffixes`;
   a fragment that is alone with its key can match nothing and is not sorted, and of the others only strings
   whose hash another string has are, as keys are often shared by chance). The common prefixes that come
   with the suffixes part them into runs that agree in `LENGTH` bytes, and the bucket answers,
   string by string, with the least doc_id that has it.
3. For each shard, the strings that have a smaller doc_id cover the bytes to remove.

Scale: no step compares documents; a passage in a third of all documents is one fragment for each shard.
Documents are streamed into shards of `SHARD_TEXT` bytes, however large the input's partitions are (a single
larger document is a shard). Buckets are as many as the size of the text asks for. Shards and tables of
fragments have names and contents that depend on the input partition alone and are put in place by renaming,
so repeated tasks are harmless. Rows go to a shard's seat once: the grouping after it needs no further exchange. The sort holds `MEMORY_BYTES` of tuples; its files are spills of the task.

Defined results: null text is empty; texts under LENGTH bytes lose nothing; repeated rows (equal doc_id) do
not make each other go; null doc_id counts as largest; an empty table gives no rows; extra columns are
ignored. An input that is no table is written first, so that repeated tasks read the same rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.suffixes import MEMORY_BYTES, suffixes
from lettermill.session import make_folder, materialize, rereadable, scratch, shuffle_width

LENGTH = 50
GRAM = 20
STRETCH = 128 << 10  # working arrays of 1 MB, which stay in a core's cache
BUCKET_TEXT = 16 << 20
SHARD_TEXT = 64 << 20
SHARD_BITS = 20  # of a shard's number that count within a partition
NOBODY = (1 << 63) - 1
MIX = np.uint64(0x9E3779B97F4A7C15)


def part_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes at each place: a polynomial, put together from parts of 1, 2, 4 ... bytes."""
    h = data.astype(np.uint64)
    h += np.uint64(1)
    p, step, done, out = int(MIX), 1, 0, h
    while True:
        if size & step:
            out = out[: len(h) - done] * np.uint64(p) + h[done:] if done else h
            done += step
        if done == size:
            return out
        h = h[:-step] * np.uint64(p) + h[step:]
        p = p * p % (1 << 64)
        step *= 2


def string_keys(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Key of the string at each place: the least mixed hash of its GRAM-byte parts; even numbers."""
    x = part_hashes(data, GRAM)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x &= ~np.uint64(1)
    width, size = length - GRAM + 1, 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def stretches(texts: Iterable[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts end to end: number of the first one, their bytes, and where each starts (and the end)."""
    held: list[bytes] = []
    size = first = k = 0
    for k, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= STRETCH:
            yield first, np.frombuffer(b"".join(held), dtype=np.uint8), np.cumsum([0, *map(len, held)])
            held, size, first = [], 0, k + 1
    if held:
        yield first, np.frombuffer(b"".join(held), dtype=np.uint8), np.cumsum([0, *map(len, held)])


def runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one key within one text: text, first string, number of strings, key."""
    none = np.empty(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    keys = string_keys(data)
    fits = np.zeros(len(data) + 1, dtype=np.int8)
    lengths = np.diff(bounds)
    full = lengths >= LENGTH
    fits[bounds[:-1][full]] += 1
    fits[bounds[1:][full] - LENGTH + 1] -= 1
    fits = np.cumsum(fits[: len(keys)], dtype=np.int8).astype(bool)
    turn = np.empty(len(keys), dtype=bool)
    turn[0] = True
    turn[1:] = (keys[1:] != keys[:-1]) | ~fits[:-1]
    start = np.flatnonzero(turn & fits)
    ends = np.flatnonzero(np.append(turn[1:] | ~fits[1:], True) & fits) + 1
    return np.searchsorted(bounds, start, side="right") - 1, start, ends - start, keys[start]


# ---- shards in the shared folder ----


def _put(folder: str, name: str, table: pa.Table) -> None:
    """Write a file under a name of the attempt, then rename: a repeated task puts the same content."""
    from pyarrow import fs, ipc

    store, where = fs.FileSystem.from_uri(folder)
    draft = f"{where}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out, ipc.new_file(out, table.schema, options=ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table, max_chunksize=2048)
    store.move(draft, f"{where}/{name}")


def _get(folder: str, name: str) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs, ipc

    store, where = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{where}/{name}") as f:
        reader = ipc.open_file(f)
        for k in range(reader.num_record_batches):
            yield reader.get_batch(k)


def _texts(folder: str, shard: int) -> Iterator[bytes]:
    for batch in _get(folder, f"shard-{shard}"):
        for x in batch.column("text"):
            yield x.as_py()


def _doc_keys(folder: str, shard: int) -> np.ndarray:
    return np.concatenate([b.column("key").to_numpy() for b in _get(folder, f"shard-{shard}")])


def _pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(array).tobytes())


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=dtype)


def _rows(cols: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols.values()], names=list(cols))


KEYS = "bucket int, shard long, keys binary"
FRAGMENTS = "bucket int, shard long, sizes binary, text binary, least binary"
ANSWERS = "bucket int, shard long, at binary, least binary"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with SHARD_TEXT bytes of text or little more."""
    if batch.num_rows > 1 and batch.nbytes > SHARD_TEXT:
        half = batch.num_rows // 2
        yield from _slices(batch.slice(0, half))
        yield from _slices(batch.slice(half))
    elif batch.num_rows:
        yield batch


def _send_keys(docs: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Step 1, first half: write shards, send keys (their lowest bit: had by two documents of the shard)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        shard = TaskContext.get().partitionId() << SHARD_BITS
        for batch in batches:
            for part in _slices(batch):
                held.append(part)
                size += part.nbytes
                if size >= SHARD_TEXT:
                    yield keys_of(shard, held)
                    held, size, shard = [], 0, shard + 1
        if held:
            yield keys_of(shard, held)

    def keys_of(shard: int, tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        _put(folder, f"shard-{shard}", pa.Table.from_batches(tables))
        found_keys, found_docs = [], []
        texts = (x.as_py() for b in tables for x in b.column("text"))
        for first, data, bounds in stretches(texts):
            doc, _, _, keys = runs(data, bounds)
            found_keys.append(keys)
            found_docs.append(doc + first)
        keys, docs_of = np.concatenate(found_keys), np.concatenate(found_docs)
        order = np.argsort(keys)
        keys, docs_of = keys[order], docs_of[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, dtype=np.int64)
        shared = np.maximum.reduceat(docs_of, heads) != np.minimum.reduceat(docs_of, heads) if len(keys) else np.empty(0, dtype=bool)
        unique = keys[heads] | shared.astype(np.uint64)
        bucket = bucket_of(keys[heads], buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        out = [(b, unique[order[cuts[b] : cuts[b + 1]]].tobytes()) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        return _rows({"bucket": ([-1, *[b for b, _ in out]], pa.int32()), "shard": ([shard] * (len(out) + 1), pa.int64()), "keys": ([b"", *[x for _, x in out]], pa.binary())})

    return docs.mapInArrow(run, KEYS)


def _answer_keys(table: pa.Table) -> pa.Table:
    """Step 1, second half: of one bucket, each shard's keys that more than one document has."""
    shards = table.column("shard").to_pylist()
    parts = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("keys")]
    every = np.sort(np.concatenate(parts))
    bare = every & ~np.uint64(1)
    twice = np.zeros(len(every), dtype=bool)
    if len(every):
        twice[1:] = bare[1:] == bare[:-1]
        twice |= (every & np.uint64(1)) == 1
    wanted = np.unique(bare[twice])
    out = []
    for shard, keys in zip(shards, parts, strict=True):
        own = keys & ~np.uint64(1)
        kept = own[_has(wanted, own)]
        if len(kept) or shard_only(table):
            out.append((shard, kept.tobytes()))
    bucket = table.column("bucket")[0].as_py()
    return pa.table({"bucket": pa.array([bucket] * len(out), pa.int32()), "shard": pa.array([s for s, _ in out], pa.int64()), "keys": pa.array([k for _, k in out], pa.binary())})


def shard_only(table: pa.Table) -> bool:
    """The rows that only tell that a shard exists."""
    return table.column("bucket")[0].as_py() < 0


def _has(sorted_values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(asked), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, asked), len(sorted_values) - 1)
    return sorted_values[at] == asked


def _send_fragments(folder: str, buckets: int):
    """Step 2, first half: of one shard, its distinct fragments; a table of its runs stays in the folder."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        wanted = np.sort(np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("keys")]))
        owners = _doc_keys(folder, shard)
        number: dict[bytes, int] = {}
        bucket_list: list[np.ndarray] = []
        table_of_runs: list[tuple[np.ndarray, ...]] = []
        for first, data, bounds in stretches(_texts(folder, shard)):
            doc, start, count, keys = runs(data, bounds)
            hit = np.flatnonzero(_has(wanted, keys))
            if not len(hit):
                continue
            doc, start, count, keys = doc[hit], start[hit], count[hit], keys[hit]
            raw = data.tobytes()
            before = len(number)
            fragment = np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip(start.tolist(), (start + count + LENGTH - 1).tolist(), strict=True)), dtype=np.int64, count=len(hit))
            fresh = np.zeros(len(number) - before, dtype=np.uint64)
            new = fragment >= before
            fresh[fragment[new] - before] = keys[new]
            bucket_list.append(bucket_of(fresh, buckets))
            table_of_runs.append((doc + first, start - bounds[doc], count, fragment))
        if not number:
            return pa.table({c.split()[0]: pa.array([], t) for c, t in zip(FRAGMENTS.split(", "), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)})
        doc, start, count, fragment = (np.concatenate(x) for x in zip(*table_of_runs, strict=True))
        bucket = np.concatenate(bucket_list)
        least = np.full(len(number), NOBODY)
        np.minimum.at(least, fragment, owners[doc])
        texts = list(number)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        out = []
        for part in np.split(order, cuts):
            own = [texts[k] for k in part.tolist()]
            out.append((int(bucket[part[0]]), _pack(np.fromiter(map(len, own), dtype="<u4", count=len(own))), zstandard.ZstdCompressor(1).compress(b"".join(own)), _pack(least[part])))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))  # fragments in the order of the answers
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))[order] - LENGTH + 1
        offset = np.cumsum(sizes) - sizes
        _put(folder, f"runs-{shard}", pa.table({"doc": doc.astype(np.uint32), "start": start.astype(np.uint32), "count": count.astype(np.uint32), "answer": offset[place[fragment]]}))
        b, s, t, m = zip(*out, strict=True)
        return pa.table({"bucket": pa.array(b, pa.int32()), "shard": pa.array([shard] * len(b), pa.int64()), "sizes": pa.array(s, pa.binary()), "text": pa.array(t, pa.binary()), "least": pa.array(m, pa.binary())})

    return run


def least_owners(text: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int = LENGTH, memory: int = MEMORY_BYTES) -> np.ndarray:
    """For strings of `length` at `starts` of fragments in a text: the least owner of an equal one."""
    number = np.zeros(len(text), dtype=np.uint32)
    number[starts] = np.arange(1, len(starts) + 1)
    group_of = np.zeros(len(starts), dtype=np.uint32)
    group, least = -1, 0  # the common prefix is the least since the last string

    def part(at: np.ndarray, common: np.ndarray) -> None:
        nonlocal group, least
        string = number[at]
        own = np.flatnonzero(string)
        if not len(own):
            least = min(least, int(common.min()))
            return
        mins = np.minimum.reduceat(common[: own[-1] + 1], np.append(0, own[:-1] + 1))
        mins[0] = min(int(mins[0]), least)
        least = int(common[own[-1] + 1 :].min(initial=length))
        turn = np.cumsum(mins < length) + group
        group = int(turn[-1])
        group_of[string[own] - 1] = turn

    suffixes(text, length, part, memory)
    best = np.full(group + 1, NOBODY)
    np.minimum.at(best, group_of, owners)
    return best[group_of]


def joined(texts: list[bytes]) -> np.ndarray:
    """Texts with a symbol between them that none has: a byte, or else 256."""
    seen = np.zeros(256, dtype=bool)
    for at in range(0, len(texts), 4096):
        seen[np.frombuffer(b"".join(texts[at : at + 4096]), dtype=np.uint8)] = True
    if not seen.all():
        return np.frombuffer(bytes([int(np.argmin(seen))]).join(texts), dtype=np.uint8)
    wide = np.frombuffer(b"\0".join(texts), dtype=np.uint8).astype(np.uint16)
    wide[np.cumsum([len(x) + 1 for x in texts])[:-1] - 1] = 256
    return wide


def rivals(texts: list[bytes]) -> np.ndarray:
    """Fragments whose key another fragment has too; any other's strings are in it alone."""
    keys = []
    for _, data, bounds in stretches(texts):
        keys.append(string_keys(data)[bounds[:-1]])
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    same = np.append(False, keys[order][1:] == keys[order][:-1])
    return np.sort(order[same | np.append(same[1:], False)])


def repeated(texts: list[bytes]) -> np.ndarray:
    """For each string of the texts, in order: whether another one has its hash. If none has, it has no equal."""
    found = []
    for _, data, bounds in stretches(texts):
        counts = np.diff(bounds) - LENGTH + 1
        found.append(part_hashes(data, LENGTH)[np.repeat(bounds[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())])
    hashes = np.concatenate(found)
    order = np.argsort(hashes)
    same = np.append(False, hashes[order[1:]] == hashes[order[:-1]])
    out = np.empty(len(hashes), dtype=bool)
    out[order] = same | np.append(same[1:], False)
    return out


def _answer_fragments(table: pa.Table) -> pa.Table:
    """Step 2, second half: of one bucket, for each shard, the least doc_id of each string of its fragments."""
    number: dict[bytes, int] = {}
    parts = []
    for sizes, text, least in zip(table.column("sizes"), table.column("text"), table.column("least"), strict=True):
        lengths = _unpack(sizes.as_py(), "<u4").astype(np.int64)
        raw = zstandard.ZstdDecompressor().decompress(text.as_py())
        ends = np.cumsum(lengths)
        ids = np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)), dtype=np.int64, count=len(lengths))
        parts.append((ids, lengths, _unpack(least.as_py(), "<i8")))
    owner = np.full(len(number), NOBODY)
    for ids, _, least in parts:
        np.minimum.at(owner, ids, least)
    texts = list(number)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    counts = lengths - LENGTH + 1
    offset = np.cumsum(counts) - counts
    least = np.repeat(owner, counts)  # right wherever no other fragment has the key
    rival = rivals(texts)
    if len(rival):
        own = counts[rival]
        turn = np.cumsum(own) - own
        twice = repeated([texts[k] for k in rival.tolist()])
        text_of = np.repeat(np.arange(len(rival)), own)
        at = np.arange(len(twice)) - turn[text_of]  # in its fragment
        asked = np.flatnonzero(twice)
        if len(asked):
            head = np.append(True, (np.diff(asked) > 1) | (at[asked[1:]] == 0))
            first = asked[head]
            size = np.diff(np.append(np.flatnonzero(head), len(asked)))
            begins = np.cumsum(size + LENGTH) - size - LENGTH
            whose = rival[text_of[first]]
            pieces = [texts[k][a : a + n + LENGTH - 1] for k, a, n in zip(whose.tolist(), at[first].tolist(), size.tolist(), strict=True)]
            starts = np.repeat(begins - np.cumsum(size) + size, size) + np.arange(len(asked))
            least[offset[rival[text_of[asked]]] + at[asked]] = least_owners(joined(pieces), starts, np.repeat(owner[whose], size))
    out = []
    for ids, own_lengths, _ in parts:
        own_counts = own_lengths - LENGTH + 1
        own_offset = np.cumsum(own_counts) - own_counts
        answer = least[np.repeat(offset[ids] - own_offset, own_counts) + np.arange(own_counts.sum())]
        at = np.flatnonzero(np.append(True, answer[1:] != answer[:-1]))
        out.append((_pack(np.append(at, len(answer)).astype("<i8")), _pack(answer[at].astype("<i8"))))
    return pa.table({"bucket": table.column("bucket"), "shard": table.column("shard"), "at": pa.array([a for a, _ in out], pa.binary()), "least": pa.array([x for _, x in out], pa.binary())})


def _remove(folder: str):
    """Step 3: of one shard, what goes and what stays."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        owners = _doc_keys(folder, shard)
        told = sorted((b, a, x) for b, a, x in zip(table.column("bucket").to_pylist(), table.column("at").to_pylist(), table.column("least").to_pylist(), strict=True) if b >= 0)
        if told:
            counts, values = [], []
            for _, at, least in told:
                counts.append(np.diff(_unpack(at, "<i8")))
                values.append(_unpack(least, "<i8"))
            counts, values = np.concatenate(counts), np.concatenate(values)
            ends = np.cumsum(counts)
            known = pa.Table.from_batches(list(_get(folder, f"runs-{shard}")))
            doc, start, count, answer = (known.column(c).to_numpy().astype(np.int64) for c in ("doc", "start", "count", "answer"))
        else:
            doc = start = count = answer = counts = values = ends = np.empty(0, dtype=np.int64)
        out: list[tuple] = []
        for first, data, bounds in stretches(_texts(folder, shard)):
            n = len(bounds) - 1
            lo, hi = np.searchsorted(doc, [first, first + n])
            size = count[lo:hi]
            turn = np.cumsum(size) - size
            each = np.arange(size.sum())
            asked = np.repeat(answer[lo:hi] - turn, size) + each
            least = values[np.searchsorted(ends, asked, side="right")]
            goes = least < np.repeat(owners[doc[lo:hi]], size)
            place = (np.repeat(bounds[doc[lo:hi] - first] + start[lo:hi] - turn, size) + each)[goes]
            change = np.bincount(place, minlength=len(data) + 1)[: len(data) + 1] - np.bincount(place + LENGTH, minlength=len(data) + 1)[: len(data) + 1]
            gone = np.cumsum(change[: len(data)]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = bounds[1:-1][bounds[1:-1] < len(data)]
            begins[inner] |= gone[inner]
            removed, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begins))
            kept = data[~gone].tobytes()
            cut = bounds - removed[bounds]
            for k in range(n):
                key = int(owners[first + k])
                out.append((None if key == NOBODY else key, int(bounds[k + 1] - bounds[k]), int(removed[bounds[k + 1]] - removed[bounds[k]]), int(spans[bounds[k + 1]] - spans[bounds[k]]), hashlib.sha256(kept[cut[k] : cut[k + 1]]).hexdigest()))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in OUT.split(", ")])

    return run


def remove_repeats(docs: DataFrame, bucket_text: int = BUCKET_TEXT) -> DataFrame:
    """The operator: doc_id, n_bytes, n_removed, n_spans, kept_sha256; one row for each document."""
    spark = docs.sparkSession
    docs = rereadable(docs)
    folder = make_folder(spark, scratch(spark, "shards"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NOBODY)).alias("key"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_text))
    sent = _send_keys(rows, folder, buckets)
    width = max(shuffle_width(spark), buckets)  # each bucket has a partition of its own
    seat = lambda rows: rows.withColumn("seat", F.pmod(F.shiftright("shard", SHARD_BITS) + F.col("shard").bitwiseAND((1 << SHARD_BITS) - 1) * 7919, F.lit(width)).cast("int")).repartitionById(width, "seat").groupBy("seat", "shard")
    wanted = materialize(sent.repartitionById(width, "bucket").groupBy("bucket").applyInArrow(_answer_keys, KEYS), "keys")
    fragments = seat(wanted).applyInArrow(_send_fragments(folder, buckets), FRAGMENTS)
    answers = materialize(fragments.repartitionById(width, "bucket").groupBy("bucket").applyInArrow(_answer_fragments, ANSWERS), "answers")
    nothing = F.lit(None).cast("binary")
    every = answers.unionByName(wanted.filter("bucket < 0").select("bucket", "shard", nothing.alias("at"), nothing.alias("least")))
    return seat(every).applyInArrow(_remove(folder), OUT)
