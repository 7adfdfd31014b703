"""Best-fit packing of token pieces by a grouping genetic algorithm on islands.

Documents become token ids, are cut into pieces of at most `capacity` tokens, and the pieces are packed
into as few sequences as possible. A chromosome is a list of bins (groups). Crossover injects whole
well-filled bins of one parent into the other, removes bins that hold duplicates of the injected pieces
and best-fits the displaced pieces. Islands evolve the same shard apart and send elites around a ring
between epochs (a join on (shard, island)).

Scale: pieces are dealt into shards of about `shard_items` by a hash of a unique row number, so neither a
repeated document nor a hot source can fill one; each shard is one row of bounded arrays. Shards of small
pieces hold more of them, `LEAST_BINS` bins' worth on average, so each level passes on a small part only. A shard whose
packing already meets the lower bound ends there. The least filled bin of each shard re-enters a further
level, until one shard is left, so at most about one bin in a shard is not tight.

Defined results: null text is empty text, an empty document is one piece holding only the end id; repeated
rows are packed each by itself; null doc_id is kept as null; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm.tokens import word_ids
from lettermill.session import materialize, shuffle_width

CAPACITY = 4096
END_ID = 1
SHARD_ITEMS = 2048
LEAST_BINS = 8
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 6

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each document."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            for i in range(0, len(texts), 512):
                for doc_id, ids in zip(doc_ids[i : i + 512], encoder.encode_all(texts[i : i + 512]), strict=True):
                    raw = ids + end
                    for k, at in enumerate(range(0, len(raw), width)):
                        part = raw[at : at + width]
                        rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=list(names))

    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return whole.mapInArrow(cut, PIECE_SCHEMA)


# ---- the genetic algorithm, on the lengths of one shard ----


def best_fit(bins: list[list[int]], loads: list[int], items: Iterable[int], lens: list[int], capacity: int) -> None:
    """Put items, longest first, each into the fullest bin with room; open a bin if there is none."""
    by_room: dict[int, list[int]] = {}
    open_rooms = 0
    for b, load in enumerate(loads):
        by_room.setdefault(capacity - load, []).append(b)
        open_rooms |= 1 << (capacity - load)
    for i in items:
        need = lens[i]
        fits = open_rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
            loads.append(0)
        bins[b].append(i)
        loads[b] += need
        left = room - need
        by_room.setdefault(left, []).append(b)
        open_rooms |= 1 << left


def lower_bound(lens: list[int], capacity: int) -> int:
    return max(-(-sum(lens) // capacity), sum(2 * x > capacity for x in lens))


def decreasing(lens: list[int], items: Iterable[int]) -> list[int]:
    return sorted(items, key=lens.__getitem__, reverse=True)


def fitness(loads: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (mean squared fill): smaller is better."""
    return len(loads), -sum((x / capacity) ** 2 for x in loads) / max(1, len(loads))


def crossover(mine: list[list[int]], other: list[list[int]], lens: list[int], capacity: int, rng: random.Random) -> tuple[list[list[int]], list[int]]:
    """Inject a run of the other parent's fullest bins; best-fit what they displace."""
    ranked = sorted(other, key=lambda b: sum(map(lens.__getitem__, b)), reverse=True)
    take = max(1, len(ranked) // 3)
    at = rng.randrange(max(1, len(ranked) // 4))
    injected = [list(b) for b in ranked[at : at + take]]
    held = bytearray(len(lens))
    for b in injected:
        for i in b:
            held[i] = 1
    bins, loose = injected, []
    rest = [b for b in mine if not any(held[i] for i in b)]
    for b in mine:
        if any(held[i] for i in b):
            loose.extend(i for i in b if not held[i])
    rest.sort(key=lambda b: sum(map(lens.__getitem__, b)))
    for b in rest[: 1 + len(rest) // 50]:  # mutation: the emptiest bins are broken up
        loose.extend(b)
    bins.extend(list(b) for b in rest[1 + len(rest) // 50 :])
    loads = [sum(map(lens.__getitem__, b)) for b in bins]
    best_fit(bins, loads, decreasing(lens, loose), lens, capacity)
    return bins, loads


def evolve(lens: list[int], capacity: int, elites: list[list[int]], seed: int, population: int, generations: int) -> list[int]:
    """One island for one epoch. elites: bin of each item, the island's own and immigrants'."""
    rng = random.Random(seed)
    bound = lower_bound(lens, capacity)
    pool: list[tuple[tuple[int, float], list[list[int]]]] = []

    def add(bins: list[list[int]], loads: list[int]) -> None:
        pool.append((fitness(loads, capacity), bins))

    for elite in elites:
        bins: list[list[int]] = [[] for _ in range(max(elite, default=-1) + 1)]
        for i, b in enumerate(elite):
            bins[b].append(i)
        add(bins, [sum(map(lens.__getitem__, b)) for b in bins])
    while len(pool) < population and (not pool or min(pool)[0][0] > bound):
        items = decreasing(lens, range(len(lens)))
        if pool:  # later founders: longest first, but for noise
            items.sort(key=lambda i: lens[i] * rng.uniform(0.7, 1.0), reverse=True)
        bins, loads = [], []
        best_fit(bins, loads, items, lens, capacity)
        add(bins, loads)
    for _ in range(generations):
        pool.sort(key=lambda x: x[0])
        if pool[0][0][0] <= bound:
            break
        del pool[population:]
        for _ in range(max(1, population // 2)):
            a, b = rng.sample(range(len(pool)), 2) if len(pool) > 1 else (0, 0)
            add(*crossover(pool[max(a, b)][1], pool[min(a, b)][1], lens, capacity, rng))
    best = min(pool, key=lambda x: x[0])[1]
    out = [0] * len(lens)
    for b, items in enumerate(best):
        for i in items:
            out[i] = b
    return out


# ---- islands as rows ----

_STATE = "shard long, island int, items array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,uid:long>>, elite array<int>, bins int, gap int, fill double"


def _epoch(state: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Evolve each (shard, island) row; `guests` holds the bins of immigrants, if any."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                shard, island = row.column("shard")[0].as_py(), row.column("island")[0].as_py()
                lens = pa.compute.struct_field(row.column("items").flatten(), "length").to_pylist()
                elites = [x for c in ("elite", "guest") if (x := row.column(c)[0].as_py()) is not None]
                grow = epoch > 0
                best = evolve(lens, capacity, elites, hash((shard, island, epoch)), POPULATION if grow else 1, GENERATIONS if grow else 0)
                loads = np.bincount(np.array(best, dtype=np.int64), weights=lens, minlength=1) if best else np.zeros(1)
                n, fill = fitness(loads.tolist(), capacity)
                yield pa.RecordBatch.from_arrays(
                    [row.column("shard"), row.column("island"), row.column("items"), pa.array([best], pa.list_(pa.int32())), pa.array([n], pa.int32()), pa.array([n - lower_bound(lens, capacity)], pa.int32()), pa.array([fill], pa.float64())],
                    names=["shard", "island", "items", "elite", "bins", "gap", "fill"],
                )

    return state.mapInArrow(run, _STATE)


def _settle(state: DataFrame, level: int, last: bool, capacity: int) -> DataFrame:
    """Rows of pieces with sequence_id and offset; sequence_id is null in the bin that goes on to the next level."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long, sequence_id long, offset long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                shard = row.column("shard")[0].as_py()
                items = row.column("items").flatten()
                bins = np.array(row.column("elite")[0].as_py(), dtype=np.int64)
                lens = pa.compute.struct_field(items, "length").to_numpy(zero_copy_only=False).astype(np.int64)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(lens[order])
                heads = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
                base = np.maximum.accumulate(np.where(heads, ends - lens[order], 0))
                offset = ends - lens[order] - base
                loads = np.bincount(bins, weights=lens)
                ids = (np.int64(level) << 56) + (np.int64(shard) << 20) + bins[order]
                keep = np.ones(len(bins), dtype=bool) if last else bins[order] != int(np.argmin(loads))
                cols = [pa.compute.struct_field(items, k).take(pa.array(order)) for k in ("doc_id", "piece", "start", "length", "ids_crc32", "uid")]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(ids, pa.int64(), mask=~keep), pa.array(offset, pa.int64())], names=[x.split()[0] for x in schema.split(", ")]
                )

    return state.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Pieces (PIECE_SCHEMA, length <= capacity) with sequence_id and offset."""
    spark: SparkSession = pieces.sparkSession
    rest = materialize(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    done: list[DataFrame] = []
    level = 0
    while True:
        n, total = rest.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        shards = max(1, min(-(-n // shard_items), total // (LEAST_BINS * capacity)))
        fields = [F.col(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "uid")]
        state = (
            rest.groupBy(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard"))
            .agg(F.array_sort(F.collect_list(F.struct("uid", "doc_id", "piece", "start", "length", "ids_crc32"))).alias("items"))
            .select("shard", F.lit(0).alias("island"), F.transform("items", lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "uid")])).alias("items"))
        )
        nobody = F.lit(None).cast("array<int>")
        state = materialize(_epoch(state.withColumns({"elite": nobody, "guest": nobody}), capacity, 0), f"islands-{level}-0")
        settled = state.filter("gap = 0")
        if not state.filter("gap > 0").isEmpty():
            apart = state.filter("gap > 0").select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "items", "elite").withColumn("guest", nobody)
            for epoch in range(1, epochs + 1):
                evolved = materialize(_epoch(apart.repartition(shuffle_width(spark), "shard", "island"), capacity, epoch), f"islands-{level}-{epoch}")
                ring = evolved.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("elite").alias("guest"))
                apart = evolved.select("shard", "island", "items", "elite").join(ring, ["shard", "island"])
            best = evolved.groupBy("shard").agg(F.min_by("island", F.struct("bins", "fill", "island")).alias("island"))
            settled = settled.unionByName(evolved.join(best, ["shard", "island"], "left_semi"))
        last = shards == 1
        placed = _settle(settled, level, last, capacity)
        if last:
            done.append(placed)
            break
        placed = materialize(placed, f"placed-{level}")
        done.append(placed.filter("sequence_id is not null"))
        rest = placed.filter("sequence_id is null").select(*fields)
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The operator: whole documents to packed pieces."""
    return pack(token_pieces(docs, tokenizer_path, capacity), capacity)
