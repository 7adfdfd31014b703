"""SimHash near-duplicates, searched with a Gray-order hierarchical index.

Fingerprints of whole texts are grouped exactly first, so copies cost one row. Distinct fingerprints are
routed by masks of bits to groups in which all agree in the masked bits:

- `near_duplicates` links 64-bit fingerprints with at most `distance` differing bits. With b blocks of bits at
  least b - distance blocks agree, so every linked pair meets in the group of some choice of b - distance blocks (pigeonhole, no
  losses).
- `keep_one` links wide fingerprints (`WIDE` words of 64 bits) that differ in at most as many bits as texts of a given
  similarity of word shingles do. Its masks are random choices of bits; there are so many that a pair right at that
  similarity meets with a probability of `MEETS`, nearer ones with more.

All rows stand in one order by (mask, masked bits, Gray rank). A run of `TILE_ROWS` of a group is a tile, which the
index searches: nodes over runs of fingerprints hold the bits that all descendants share (a mask and a
pattern), up to a root. A query descends, and a node whose shared bits already differ in too many
places drops its whole run. Tiles of one group are leaves of the same kind of tree: pairs of nodes that differ too much are
dropped by joins, level by level, and only what is left is compared.

Scale: the number of masked bits follows the number of distinct fingerprints, so that an average group holds a few rows.
A group of any size is spread over tasks by its Gray order; no step gathers it. A tile, or a pair of tiles,
returns a spanning forest of its links (the first links that join two of its sets), never all pairs; the
components of all links follow from the forests.

Defined results: a text without words (null, empty) has fingerprint 0, linked like any other; a text with
fewer words than a shingle has is one shingle; repeated rows share a fingerprint and each get a row; a null doc_id is
kept and ranked after all others; an empty table gives no rows; extra columns are ignored. keep_one breaks ties
of doc_id by the place of the row; an input that is no table is written first.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.operators.components import connected_components
from lettermill.operators.skew import join_unique
from lettermill.session import materialize, rereadable, shuffle_width

SHINGLE = 4
DISTANCE = 4
SEED = 42
GROUP_ROWS = 512
TILE_ROWS = 4096
FAN = 8
FAN_TILES = 64
#: For texts by the similarity of their shingles: shingle, similarity, words of a wide fingerprint, chance to meet.
NEAR_SHINGLE = 5
SIMILARITY = 0.8
WIDE = 4
MEETS = 0.95


def _shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each of a text's word shingles, repeats included; none for a text without words."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.empty(0, dtype="<u8")
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(line, SEED)], dtype="<u8")
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    pairs = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], SEED) for a, b in pairs), dtype="<u8", count=n)


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Words of the bits that over half the hashes (rows of words) have."""
    ones = np.zeros(64 * hashes.shape[1], dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[at : at + (1 << 14)])
        ones += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The majority of the XXH64 bits of a text's word shingles, repeats included."""
    hashes = _shingle_hashes(text, shingle)
    return int(_majority(hashes[:, None])[0])


def wide_fingerprint(text: bytes, shingle: int = NEAR_SHINGLE, words: int = WIDE) -> bytes:
    """The same over `words` words, made from each XXH64 by mixing it with a number of the word."""
    hashes = _shingle_hashes(text, shingle)
    x = hashes[:, None] + np.arange(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return _majority(x ^ (x >> np.uint64(31))).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(run, "doc_id long, fp long")


# ---- the index ----


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each bit string in the Gray code sequence."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of nodes over fingerprints (rows of words) in Gray order; a node is the bits (mask, pattern) its run shares."""

    def __init__(self, fps: np.ndarray):
        fps = fps.reshape(len(fps), -1)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [(np.full_like(fps, ~np.uint64(0)), fps)]
        low, high = fps, fps
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            mask = ~(low ^ high)
            self.levels.append((mask, low & mask))

    def near(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, entry) index pairs that differ in at most `distance` bits."""
        queries = queries.reshape(len(queries), -1)
        for at in range(0, len(queries), 1024):
            part = queries[at : at + 1024]
            q = np.arange(len(part))
            node = np.zeros(len(part), dtype=np.int64)
            for level in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[level]
                keep = np.bitwise_count((part[q] ^ pattern[node]) & mask[node]).sum(axis=1) <= distance
                q, node = q[keep], node[keep]
                if level:
                    size = len(self.levels[level - 1][0])
                    q = np.repeat(q, FAN)
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    inside = node < size
                    q, node = q[inside], node[inside]
            yield q + at, node


def _forest(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Pairs that join two sets, in order: a spanning forest of the graph."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            rx, ry = find(x), find(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                kept.append((x, y))
    return kept


def linked_in(left: np.ndarray, right: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Places of a spanning forest of the links among `left`, or between `left` and `right` (placed after it); left in Gray order."""
    index = GrayIndex(left)
    if right is None:
        return _forest(len(left), ((q[q < e], e[q < e]) for q, e in index.near(left, distance)))
    return _forest(len(left) + len(right), ((q + len(left), e) for q, e in index.near(right, distance)))


# ---- routing and tiles ----


def block_masks(blocks: int, distance: int = DISTANCE) -> list[int]:
    """Bit masks of every choice of blocks - distance out of `blocks` blocks of the 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << (hi - lo)) - 1) << lo for lo, hi in itertools.pairwise(edges)]
    return [sum(x) for x in itertools.combinations(single, blocks - distance)]


def blocks_for(distinct: int, distance: int = DISTANCE) -> int:
    """Fewest blocks whose groups hold about GROUP_ROWS rows each."""
    return next((b for b in range(distance + 1, distance + 5) if distinct >> (64 * (b - distance) // b) <= GROUP_ROWS), distance + 4)


def random_masks(n: int, words: int, similarity: float) -> np.ndarray:
    """Rows of words: masks of so many bits that n fingerprints fall into groups of a few, and enough for MEETS."""
    bits = min(48, max(8, n.bit_length() - 2))
    agree = (1.0 - bits_apart(similarity)) ** bits
    tables = max(1, math.ceil(math.log(1.0 - MEETS) / math.log(1.0 - agree)))
    rng = np.random.default_rng(17)
    masks = np.zeros((tables, words), dtype=np.uint64)
    for mask in masks:
        for bit in rng.choice(64 * words, bits, replace=False).tolist():
            mask[bit >> 6] |= np.uint64(1 << (bit & 63))
    return masks


def bits_apart(similarity: float) -> float:
    """Share of bits in which two texts differ whose sets of shingles have that Jaccard similarity."""
    return math.acos(2.0 * similarity / (1.0 + similarity)) / math.pi


def bits_allowed(similarity: float, words: int) -> int:
    """Differing bits up to which a pair counts: the expected ones and one standard deviation."""
    share, bits = bits_apart(similarity), 64 * words
    return int(bits * share + math.sqrt(bits * share * (1.0 - share)))


ROUTED = "mask int, block long, rank long, id long, fp binary"
MADE = "src long, dst long, mask int, block long, tile long, ids binary, fps binary"


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as binary values."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _words(column: pa.Array, words: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if len(column) else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]].view("<u8").reshape(-1, words) if len(column) else np.empty((0, words), dtype="<u8")


def _routed(distinct: DataFrame, masks: np.ndarray) -> DataFrame:
    """A row for each fingerprint and mask, from (id, fp as a long or as binary)."""
    words = masks.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = part.column(0).to_numpy()
                fps = _words(part.column(1), words) if pa.types.is_binary(part.column(1).type) else part.column(1).to_numpy().view(np.uint64).reshape(-1, 1)
                block = np.zeros((len(masks), len(ids)), dtype=np.uint64)
                for w in range(words):  # of one word the masked bits themselves, of several a hash
                    block = (block ^ (fps[None, :, w] & masks[:, w, None])) * (np.uint64(1) if words == 1 else np.uint64(0x9E3779B97F4A7C15))
                    if words > 1:
                        block ^= block >> np.uint64(29)
                rank = (gray_rank(fps[:, 0].copy()) ^ np.uint64(1 << 63)).view(np.int64)
                each, n = np.tile(np.arange(len(ids)), len(masks)), len(masks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(n, dtype=np.int32), len(ids))), pa.array(block.view(np.int64).ravel()), pa.array(np.tile(rank, n)), pa.array(np.tile(ids, n)), _binary(np.ascontiguousarray(fps[each]).view(np.uint8))],
                    names=["mask", "block", "rank", "id", "fp"],
                )

    return distinct.mapInArrow(run, ROUTED)


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """src, dst: links between distinct fingerprints (column fp) that span all components."""
    masks = block_masks(blocks_for(distinct.count(), distance), distance)
    return _links(distinct.select(F.col("fp").alias("id"), "fp"), np.array(masks, dtype=np.uint64)[:, None], distance)


def _links(distinct: DataFrame, masks: np.ndarray, distance: int) -> DataFrame:
    """Links between rows (id, fp): within tiles, then between the tiles of a group that may differ little enough."""
    words = masks.shape[1]
    order = ["mask", "block", "rank", "id"]
    width = shuffle_width(distinct.sparkSession)
    # Ids, not fingerprints, decide on equal ranks, so the borders between partitions are fixed.
    ordered = _routed(distinct, masks).repartitionByRange(width, *order).sortWithinPartitions(*order)
    made = materialize(ordered.select("mask", "block", "id", "fp").mapInArrow(_tiler(words, distance), MADE), "tiles")
    within = made.filter("src is not null").select("src", "dst")
    pairs = _tile_pairs(made.filter("ids is not null"), words, distance)
    if pairs is None:
        return within.distinct()
    payload = made.filter("ids is not null").select("tile", "ids", "fps")
    both = pairs.join(payload.toDF("left", "left_ids", "left_fps"), "left").join(payload.toDF("right", "right_ids", "right_fps"), "right")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["left_ids", "left_fps", "right_ids", "right_fps"]).to_pylist():
                ids = np.concatenate([np.frombuffer(row[f"{side}_ids"], dtype="<i8") for side in ("left", "right")])
                left, right = (np.frombuffer(row[f"{side}_fps"], dtype="<u8").reshape(-1, words) for side in ("left", "right"))
                found = np.array(linked_in(left, right, distance), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(ids[found[:, 0]]), pa.array(ids[found[:, 1]])], names=["src", "dst"])

    between = both.repartition(width, "left", "right").mapInArrow(run, "src long, dst long")
    return within.unionByName(between).distinct()


def _tiler(words: int, distance: int):
    """Of one partition in order: the links within each tile, and tiles of groups that may have more than one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 33)
        keys, ids, fps = np.empty((0, 2), dtype=np.int64), np.empty(0, dtype=np.int64), np.empty((0, words), dtype="<u8")
        open_group = True  # the first group held may have tiles elsewhere

        def out(found: list[np.ndarray], tiles: list[tuple]) -> pa.RecordBatch:
            ends = np.concatenate([np.empty((0, 2), dtype=np.int64), *found])
            n, k = len(ends), len(tiles)
            cols = list(zip(*tiles, strict=True)) or [[]] * 5
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            sides = [pa.concat_arrays([pa.array(ends[:, j]), pa.nulls(k, pa.int64())]) for j in (0, 1)]
            rest = [pa.concat_arrays([pa.nulls(n, t), pa.array(c, t)]) for c, t in zip(cols, types, strict=True)]
            return pa.RecordBatch.from_arrays(sides + rest, names=[x.split()[0] for x in MADE.split(", ")])

        def search(a: int, b: int, found: list, tiles: list, keep: bool) -> None:
            """One tile, rows a to b of what is held."""
            forest = np.array(linked_in(fps[a:b], None, distance), dtype=np.int64).reshape(-1, 2) + a
            found.append(ids[forest].reshape(-1, 2))
            if keep:
                tiles.append((int(keys[a, 0]), int(keys[a, 1]), next(number), ids[a:b].tobytes(), fps[a:b].tobytes()))

        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                keys = np.concatenate([keys, np.stack([batch.column("mask").to_numpy().astype(np.int64), batch.column("block").to_numpy()], axis=1)])
                ids, fps = np.concatenate([ids, batch.column("id").to_numpy()]), np.concatenate([fps, _words(batch.column("fp"), words)])
            if not len(ids):
                continue
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            found, tiles = [], []
            small = np.full(len(ids), -1, dtype=np.int64)
            done = cuts[-2] if batch is not None else len(ids)  # the last group may go on
            for k, (a, b) in enumerate(itertools.pairwise(cuts)):
                last = b == len(ids)
                if last and batch is not None:
                    while b - done > TILE_ROWS:  # its full tiles are done with
                        search(done, done + TILE_ROWS, found, tiles, True)
                        done += TILE_ROWS
                    grown = done > a
                    break
                keep = (k == 0 and open_group) or last or b - a > TILE_ROWS
                if keep or b - a > 2 * FAN:
                    for at in range(a, b, TILE_ROWS):
                        search(at, min(b, at + TILE_ROWS), found, tiles, keep)
                elif b - a > 1:
                    small[a:b] = k
            for shift in range(1, 2 * FAN if (small >= 0).any() else 1):  # groups of one leaf run or two: by shift
                same = np.flatnonzero((small[shift:] == small[:-shift]) & (small[shift:] >= 0))
                same = same[np.bitwise_count(fps[same + shift] ^ fps[same]).sum(axis=1) <= distance]
                found.append(np.stack([ids[same], ids[same + shift]], axis=1))
            yield out(found, tiles)
            if batch is not None:
                open_group = grown or (len(cuts) == 2 and open_group)
            keys, ids, fps = keys[done:], ids[done:], fps[done:]

    return run


def _tile_pairs(tiles: DataFrame, words: int, distance: int) -> DataFrame | None:
    """left, right: tiles of one group whose shared bits differ in at most `distance` places; None if no group has two."""

    def bounds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for x in batch.column("fps"):
                fps = np.frombuffer(x.as_py(), dtype="<u8").reshape(-1, words)
                low.append(np.bitwise_and.reduce(fps).view(np.int64))
                high.append(np.bitwise_or.reduce(fps).view(np.int64))
            sides = [pa.array(np.array(v, dtype=np.int64).reshape(-1, words)[:, w]) for v in (low, high) for w in range(words)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("mask", "block", "tile")] + sides, names=["mask", "block", "tile", *names])

    names = [f"{end}{w}" for end in ("low", "high") for w in range(words)]
    whole, by_tile = Window.partitionBy("mask", "block"), Window.partitionBy("mask", "block").orderBy("tile")
    seen = tiles.select("mask", "block", "tile", "fps").mapInArrow(bounds, "mask int, block long, tile long, " + ", ".join(f"{n} long" for n in names))
    leaf = seen.withColumn("of", F.count("*").over(whole)).filter("of > 1").withColumn("node", F.row_number().over(by_tile).cast("long") - 1).drop("of")
    levels = [materialize(leaf, "nodes")]
    while (most := levels[-1].agg(F.max("node")).first()[0]) is not None and most >= FAN_TILES:
        up = levels[-1].groupBy("mask", "block", F.floor(F.col("node") / FAN_TILES).alias("node"))
        levels.append(materialize(up.agg(*[(F.bit_and if n.startswith("low") else F.bit_or)(n).alias(n) for n in names]), "nodes"))
    if most is None:
        return None

    def apart(a: str, b: str) -> Column:
        """Bits that all under either node share, and that differ."""
        total = F.lit(0)
        for w in range(words):
            al, ah, bl, bh = (F.col(f"{side}.{end}{w}") for side in (a, b) for end in ("low", "high"))
            total = total + F.bit_count(al.bitwiseXOR(bl).bitwiseAND(F.bitwise_not(al.bitwiseXOR(ah))).bitwiseAND(F.bitwise_not(bl.bitwiseXOR(bh))))
        return total

    pairs = None
    for depth in range(len(levels) - 1, -1, -1):
        level, apex = levels[depth], pairs is None
        a, b = level.alias("a"), level.alias("b")
        if apex:
            met = a.join(b, (F.col("a.mask") == F.col("b.mask")) & (F.col("a.block") == F.col("b.block")) & (F.col("a.node") <= F.col("b.node")))
        else:
            under = lambda side: F.floor(F.col(f"{side}.node") / FAN_TILES)
            group = lambda side: (F.col("p.mask") == F.col(f"{side}.mask")) & (F.col("p.block") == F.col(f"{side}.block"))
            met = pairs.alias("p").join(a, group("a") & (F.col("p.left") == under("a"))).join(b, group("b") & (F.col("p.right") == under("b")) & (F.col("a.node") <= F.col("b.node")))
        met = met.filter(apart("a", "b") <= distance)
        if depth:
            pairs = met.select("a.mask", "a.block", F.col("a.node").alias("left"), F.col("b.node").alias("right"))
        else:
            pairs = met.filter("a.node < b.node").select(F.col("a.tile").alias("left"), F.col("b.tile").alias("right")).distinct()
    return materialize(pairs, "tile-pairs")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The operator: doc_id, fp, component_id (least doc_id of all documents reachable over links)."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    parts = connected_components(links(distinct.select("fp"), distance))
    of = materialize(distinct.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("part")), "parts")
    least = of.groupBy("part").agg(F.min("first").alias("component_id"))
    known = join_unique(of, least, "part").select("fp", "component_id")
    return join_unique(prints, known, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = NEAR_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Documents with one row kept of each group of texts alike by their shingles: that with the least doc_id (then place)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [wide_fingerprint(x.as_py(), shingle) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(fps, pa.binary())], names=["row", "doc_id", "fp"])

    docs = rereadable(docs)
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("doc"))
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit("")).cast("binary")
    prints = numbered.select(F.col("_row").alias("row"), F.col("doc.doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, "row long, doc_id long, fp binary")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    distinct = materialize(prints.groupBy("fp").agg(F.min(rank).alias("first")).withColumn("id", F.monotonically_increasing_id()), "distinct")
    masks = random_masks(distinct.count(), WIDE, similarity)
    parts = connected_components(_links(distinct.select("id", "fp"), masks, bits_allowed(similarity, WIDE)))
    of = distinct.join(parts, F.col("id") == F.col("node"), "left").select("first", F.coalesce("component", "id").alias("part"))
    kept = of.groupBy("part").agg(F.min("first").alias("first")).select(F.col("first.row").alias("_row"))
    return numbered.join(kept, "_row", "left_semi").select("doc.*")
