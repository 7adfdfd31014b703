"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A text is cut, losing no byte, into sections (blank lines, and lines whose hash says so), sections into
paragraphs (lines), paragraphs into pieces: words with the space after them; longer stretches without spaces
are cut by a rolling hash, and no piece is over `MOST_BYTES`. All cuts follow from the bytes around them, so an
edit moves no cut far from it, and texts of any length are cut alike. A paragraph's digest is the hash of its
bytes, that of a node above the hash of its children's; the root tells whether texts are equal, and only
differing sections are descended to locate an edit.

The fingerprint is a string: root digest, bytes of text, short digests of the sections, and the leaves. A leaf is
a piece, and its digest covers the piece before it too, so that common words alone make no likeness. Of
more than `MOST_LEAVES` distinct leaves those with the least digests stand for all, and the string says up to which
digest. The likeness of two fingerprints follows from the strings alone: the share (Dice, by bytes) of equal
leaves, as far as both have them all. Up to `MOST_LEAVES` it is exact; beyond, its standard error is about 0.03.

Scale: neighbours in doc_id order meet without a global sort of texts: a sort of (doc_id, hash of the text) alone
gives the borders of ranges, the first document of the next range is added to each, and a range is
streamed in order, two trees at a time. Texts are shuffled once. Copies of a row stand in several ranges if
they are many. Ranges have about `RANGE_ROWS` documents, and more only beyond `MOST_RANGES` of them.

Defined results: null text is empty; an empty text has a tree without sections, alike only to another empty
one; null doc_id comes first; equal doc_ids follow each other by the hash of their text (xxhash64); a single
document is its own next one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.session import rereadable

RANGE_ROWS = 2048
MOST_RANGES = 100_000
MOST_LEAVES = 256
WORD_BYTES = 16  # a longer stretch without spaces is cut by content too, at one code point in eight
MOST_BYTES = 128  # and so is a piece that is longer
SECTION_CUT = 8  # one line in eight ends a section
BASE = 0x9E3779B97F4A7C15
LEAF = np.dtype([("digest", "<u4"), ("size", "<u4")])


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass
class Fingerprint:
    """What the string holds. leaves: distinct digests below `limit`, rising, with the bytes under each."""

    root: str
    size: int
    sections: str
    limit: int
    leaves: np.ndarray

    def __str__(self) -> str:
        return f"{self.root}:{self.size}:{self.sections}:{self.limit:x}:{base64.b64encode(self.leaves.tobytes()).decode()}"

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        root, size, sections, limit, leaves = text.split(":")
        return cls(root, int(size), sections, int(limit, 16), np.frombuffer(base64.b64decode(leaves), dtype=LEAF))


@dataclass
class Tree:
    """Digests by level; children of section k are the paragraphs first[k]..first[k + 1]."""

    text: bytes
    root: bytes
    sections: list[bytes]
    section_first: list[int]
    paragraphs: list[bytes]
    paragraph_sizes: list[int]
    ends: np.ndarray

    @property
    def size(self) -> int:
        return len(self.text)

    @property
    def piece_sizes(self) -> list[int]:
        return np.diff(self.ends, prepend=0).tolist()

    def fingerprint(self) -> Fingerprint:
        digests, sizes = _leaves(self.text, self.ends)
        order = np.argsort(digests, kind="stable")
        digests = digests[order]
        heads = np.flatnonzero(np.append(True, digests[1:] != digests[:-1])) if len(digests) else np.empty(0, dtype=np.int64)
        leaves = np.empty(len(heads), dtype=LEAF)
        leaves["digest"] = digests[heads]
        if len(heads):
            leaves["size"] = np.minimum(np.add.reduceat(sizes[order], heads), (1 << 32) - 1)
        limit = 1 << 32
        if len(leaves) > MOST_LEAVES:
            limit, leaves = int(leaves["digest"][MOST_LEAVES]), leaves[:MOST_LEAVES]
        return Fingerprint(self.root.hex(), self.size, "".join(s[:4].hex() for s in self.sections), limit, leaves)


_POWERS: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2^64; kept for texts of up to a million bytes."""
    if len(_POWERS[0]) <= n:
        size = 1 << n.bit_length()
        made = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if size > 1 << 20:
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def _leaves(text: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digest of each piece together with the one before it, and the piece's bytes."""
    up, down = _powers(len(text))
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(data * up[: len(text)], out=sums[1:])
    starts = np.append(0, ends[:-1])[: len(ends)]
    before = np.append(0, starts[:-1])[: len(ends)]
    x = (sums[ends] - sums[before]) * down[before]
    x += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(32)).astype(np.uint32), ends - starts


def _cuts(text: bytes) -> np.ndarray:
    """Ends of pieces."""
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    data = np.frombuffer(text, dtype=np.uint8)
    space = np.flatnonzero((data == 32) | (data == 10))
    ends = space + 1
    edges = np.concatenate([[-1], space, [n]])
    long = np.flatnonzero(np.diff(edges) > WORD_BYTES + 1)
    if len(long):  # stretches without spaces: cut where the four bytes before say so, between code points
        inside = np.concatenate([np.arange(edges[k] + 1 + WORD_BYTES, edges[k + 1]) for k in long.tolist()])
        inside = inside[(data[inside] & 0xC0) != 0x80]
        four = sum(data[inside - 4 + k].astype(np.uint32) << np.uint32(8 * k) for k in range(4)) * np.uint32(0x9E3779B1)
        inside = inside[four <= 0x1FFF_FFFF]
        if len(inside):
            ends = np.union1d(ends, inside)
    gaps = np.diff(ends, prepend=0, append=n)
    if int(gaps.max()) > MOST_BYTES:
        starts = np.concatenate([[0], ends])
        ends = np.union1d(ends, np.concatenate([np.arange(starts[k] + MOST_BYTES, starts[k] + gaps[k], MOST_BYTES) for k in np.flatnonzero(gaps > MOST_BYTES).tolist()]))
    return ends if len(ends) and ends[-1] == n else np.append(ends, n)


def build(text: bytes) -> Tree:
    lines = [x + b"\n" for x in text.split(b"\n")]
    lines[-1] = lines[-1][:-1]
    if not lines[-1]:
        del lines[-1]
    paragraphs, sizes = [_digest(x) for x in lines], [len(x) for x in lines]
    section_first, sections = [0], []
    for k, (digest, size) in enumerate(zip(paragraphs, sizes, strict=True)):
        if size == 1 or digest[0] % SECTION_CUT == 0 or k == len(paragraphs) - 1:
            sections.append(_digest(b"".join(paragraphs[section_first[-1] : k + 1])))
            section_first.append(k + 1)
    return Tree(text, _digest(b"root" + b"".join(sections)), sections, section_first, paragraphs, sizes, _cuts(text))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1; 1 exactly for equal roots."""
    if a.root == b.root:
        return 1.0
    limit = min(a.limit, b.limit)
    x, y = (f.leaves[: np.searchsorted(f.leaves["digest"], limit)] if f.limit > limit else f.leaves for f in (a, b))
    total = int(x["size"].sum(dtype=np.int64) + y["size"].sum(dtype=np.int64))
    if not total:
        return 0.0
    at = np.searchsorted(y["digest"], x["digest"])
    met = np.flatnonzero(at < len(y))
    met = met[y["digest"][at[met]] == x["digest"][met]]
    shared = int(np.minimum(x["size"][met], y["size"][at[met]]).sum(dtype=np.int64))
    return min(2.0 * shared / total, 1.0 - 2.0**-40)


def _alike(a: Tree, b: Tree, step: int) -> int:
    """Bytes at the beginning (step 1) or the end (-1) that equal sections, then paragraphs, then pieces cover."""
    turn = (lambda x: x) if step > 0 else (lambda x: x[::-1])
    k = done = 0
    for p, q in zip(turn(a.sections), turn(b.sections), strict=False):
        if p != q:
            break
        k += 1
    lines = a.section_first[k] if step > 0 else len(a.paragraphs) - a.section_first[len(a.sections) - k]
    done = sum(turn(a.paragraph_sizes)[:lines])
    for p, q, size in zip(turn(a.paragraphs)[lines:], turn(b.paragraphs)[lines:], turn(a.paragraph_sizes)[lines:], strict=False):
        if p != q:
            break
        done += size
    most = min(a.size, b.size)
    mine, theirs = (np.concatenate([[0], t.ends]) if step > 0 else t.size - np.concatenate([[0], t.ends])[::-1] for t in (a, b))
    for x in mine[(mine > done) & np.isin(mine, theirs) & (mine <= most)].tolist():
        if (a.text[done:x] != b.text[done:x]) if step > 0 else (a.text[a.size - x : a.size - done] != b.text[b.size - x : b.size - done]):
            break
        done = x
    return done


def edited_range(a: Tree, b: Tree) -> tuple[int, int]:
    """Bytes of a's text between the branches that begin both alike and those that end both alike."""
    if a.root == b.root:
        return 0, 0
    head, tail = _alike(a, b, 1), _alike(a, b, -1)
    return head, a.size - min(tail, min(a.size, b.size) - head)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edit_from long, edit_to long"


def _compare(text: str, mine: tuple[Tree, Fingerprint], following: str, theirs: tuple[Tree, Fingerprint]) -> tuple:
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    tree = build(edited)
    said = tree.fingerprint()
    return (len(text), hashlib.sha256(edited).hexdigest(), str(mine[1]), str(said), likeness(mine[1], said), likeness(mine[1], theirs[1]), *edited_range(mine[0], tree))


def _composite(*columns: np.ndarray) -> np.ndarray:
    """Rows of signed numbers as byte strings of the same order."""
    out = np.empty((len(columns[0]), len(columns)), dtype=">u8")
    for k, column in enumerate(columns):
        out[:, k] = np.asarray(column, dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view(f"S{8 * len(columns)}").ravel()


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """The operator: each document against its edited text and the next document, ascending doc_id."""
    spark = docs.sparkSession
    docs = rereadable(docs)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The salt parts copies of a row, which are in no order; it decides on ranges only.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), F.xxhash64(text).alias("hash"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"), text.alias("text"))
    keys = rows.select("key", "hash", "salt")
    count = keys.count()
    if not count:
        return spark.createDataFrame([], SCHEMA)
    wanted = min(MOST_RANGES, -(-count // RANGE_ROWS))
    spread = keys.repartitionByRange(wanted, "key", "hash", "salt") if wanted > 1 else keys.coalesce(1)
    firsts = spread.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("key", "hash", "salt")).alias("first")).select("first.*").collect()  # a row for each range
    firsts = sorted((r["key"], r["hash"], r["salt"]) for r in firsts)
    bounds = _composite(*zip(*firsts, strict=True))[1:]
    ranges = len(firsts)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series, hashes: pd.Series, salts: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, _composite(keys.to_numpy(), hashes.to_numpy(), salts.to_numpy()), side="right").astype(np.int32))

    # The first document of each range also goes to the range before it (of the first range, to the last one).
    to: dict[tuple[int, int], list[int]] = {}
    for k, (a, b, _) in enumerate(firsts):
        to.setdefault((a, b), []).append((k - 1) % ranges)
    asked = F.broadcast(spark.createDataFrame([(a, b, t) for (a, b), t in to.items()], "key long, hash long, to array<int>"))  # MOST_RANGES rows at most
    guests = rows.join(asked, ["key", "hash"]).groupBy("key", "hash", "to").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    guests = guests.select("doc_id", "key", "hash", "text", F.explode("to").alias("range"), F.lit(1).alias("guest"))
    own = rows.select("doc_id", "key", "hash", "text", range_of("key", "hash", "salt").alias("range"), F.lit(0).alias("guest"))
    together = own.unionByName(guests).repartitionById(ranges, "range").sortWithinPartitions("range", "guest", "key", "hash")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # range, doc_id, text, its tree and fingerprint
        for batch in batches:
            out = []
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for k, where in enumerate(batch.column("range").to_pylist()):
                text = texts[k].as_py()
                tree = build(text.encode())
                made = tree, tree.fingerprint()
                if before is not None and before[0] == where:
                    out.append((before[1], *_compare(before[2], before[3], text, made)))
                before = (where, ids[k], text, made)
            cols = list(zip(*out, strict=True)) or [[]] * 9
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return together.mapInArrow(run, SCHEMA)
