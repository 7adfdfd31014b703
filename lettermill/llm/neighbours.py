"""Approximate nearest neighbours by cosine: stable projections, kd-trees and a chi-square stopping test.

Unit vectors are projected by a Gaussian (2-stable) matrix to `DIMS` numbers, in which squared distances are
the true ones times a chi-square variable. The projections are indexed by a kd-tree: its upper levels, fitted
on a bounded sample, deal all vectors into cells; each cell's own tree ends in leaves. A query takes leaves in
the order of projected distance and verifies, on the original vectors, only points whose own projected
distance r passes the test: a point as near as the query's k-th best so far would have been projected within
r with a probability under `SURE`. It stops at the first leaf that fails the test as a whole.

A query searches its own cell first; its k-th distance there rules out other cells by the same test, and the
rest are searched too. Queries meet a cell in blocks. `verified` counts the rows whose original vectors a query read.

Scale: equal vectors are one class of which only the k + 1 least vec_ids can ever be among the nearest, so a
common vector costs k + 1 rows. A cell is held in parts of `PART_ROWS` at most. Every row is indexed; only
the places of the cells' borders come from a sample (`SAMPLE_ROWS`).

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a
null vec_id, take no part; vectors of another length than the query's are no candidates; rows with the
query's vec_id are its own; repeated rows count once; no candidates give no rows; an empty table gives no
rows; extra columns are ignored. Vectors are scaled by powers of two first, which changes no cosine, so the
squares of very large and very small numbers neither overflow nor vanish.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettermill.session import materialize

NEAREST = 5
DIMS = 32
SURE = 0.9
SAMPLE_ROWS = 20_000
PART_ROWS = 16_384
MOST_CELLS = 4096
QUERY_BLOCK = 16_384
LEAF = 128
ROUNDS = 12
EPS = 1e-9

FOUND = "query_id long, vec_id long, score double, verified long"


def within(x):
    """Chi-square distribution function with DIMS (even) degrees of freedom."""
    half = np.asarray(x, dtype=np.float64) / 2.0
    term = total = np.exp(-np.minimum(half, 700.0))
    for i in range(1, DIMS // 2):
        term = term * half / i
        total = total + term
    return 1.0 - total


def _quantile(share: float) -> float:
    """The chi-square value that `share` of the distribution is below."""
    low, high = 0.0, 100.0 * DIMS
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if within(middle) < share else (low, middle)
    return high


STOP = _quantile(SURE)


def reach_of(kth: np.ndarray) -> np.ndarray:
    """Squared projected distance within which points as near as cosine kth are projected with probability SURE."""
    return STOP * np.maximum(2.0 - 2.0 * kth, 1e-12)


def projection(width: int) -> np.ndarray:
    return np.random.default_rng(11).normal(size=(width, DIMS))


def project(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)) @ projection(vectors.shape[1])


def matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix of doubles, each row scaled by a power of two to below 1."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros((0, 1))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    return np.ldexp(values, -np.frexp(np.abs(values).max(axis=1))[1][:, None])


def kd_split(points: np.ndarray, parts: int) -> list[np.ndarray]:
    """Indices of points by median splits of the widest dimension, into about `parts` leaves."""
    todo, done = [(np.arange(len(points)), parts)], []
    while todo:
        index, want = todo.pop()
        if want <= 1 or len(index) < 2:
            done.append(index)
            continue
        own = points[index]
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        half = len(index) * (want // 2) // want
        order = np.argpartition(own[:, axis], half)
        todo += [(index[order[:half]], want // 2), (index[order[half:]], want - want // 2)]
    return done


def borders(points: np.ndarray, cells: int) -> list[tuple]:
    """Upper levels of the tree as nested (axis, cut, below, above), numbers being cells."""
    number = iter(range(cells))

    def node(own: np.ndarray, want: int):
        if want <= 1 or len(own) < 2:
            return next(number)
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        cut = float(np.quantile(own[:, axis], (want // 2) / want))
        low = own[:, axis] < cut
        return axis, cut, node(own[low], want // 2), node(own[~low], want - want // 2)

    return node(points, cells)


def cell_of(points: np.ndarray, tree) -> np.ndarray:
    out = np.zeros(len(points), dtype=np.int64)
    todo = [(np.arange(len(points)), tree)]
    while todo:
        index, at = todo.pop()
        if isinstance(at, int):
            out[index] = at
            continue
        axis, cut, below, above = at
        low = points[index, axis] < cut
        todo += [(index[low], below), (index[~low], above)]
    return out


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """[queries, boxes] squared distances."""
    total = np.zeros((len(q), len(low)))
    for k in range(DIMS):
        gap = np.maximum(0.0, np.maximum(low[None, :, k] - q[:, None, k], q[:, None, k] - high[None, :, k]))
        total += gap * gap
    return total


def search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, kth: np.ndarray, k: int) -> list[tuple]:
    """FOUND rows of one part for some queries; kth: the k-th best cosine known so far (-inf: none)."""
    points = project(vectors)
    leaves = kd_split(points, max(1, len(points) // LEAF))
    order = np.concatenate(leaves)
    points, vectors, ids = points[order], vectors[order], ids[order]  # a leaf is a slice
    starts = np.cumsum([0, *map(len, leaves)])
    low, high = np.minimum.reduceat(points, starts[:-1]), np.maximum.reduceat(points, starts[:-1])
    square = (points * points).sum(axis=1)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    unit = vectors / norms[:, None]
    out: list[tuple] = []
    for at in range(0, len(queries), 256):
        q, qid = queries[at : at + 256], query_ids[at : at + 256]
        q_norm = np.sqrt((q * q).sum(axis=1))
        q_unit, p = q / q_norm[:, None], project(q)
        p_square = (p * p).sum(axis=1)
        boxes = box_distance(p, low, high)
        turns = np.argsort(boxes, axis=1)
        score = np.full((len(q), len(vectors)), -np.inf)
        top = np.repeat(kth[at : at + 256, None], k, axis=1)  # k values that are known to be reached
        reach, verified = reach_of(top.min(axis=1)), np.zeros(len(q), dtype=np.int64)
        active, begin, step = np.arange(len(q)), 0, 1
        while begin < len(leaves):
            active = active[boxes[active, turns[active, begin]] <= reach[active]]
            if not len(active):
                break
            turn = turns[active, begin : begin + step]
            rows, which = np.repeat(active, turn.shape[1]), turn.ravel()
            by_leaf = np.argsort(which, kind="stable")
            cuts = np.searchsorted(which[by_leaf], np.arange(len(leaves) + 1))
            for leaf in np.unique(which).tolist():
                r, own = rows[by_leaf[cuts[leaf] : cuts[leaf + 1]]], slice(starts[leaf], starts[leaf + 1])
                projected = p_square[r][:, None] + square[own] - 2.0 * (p[r] @ points[own].T)
                i, j = np.nonzero((projected <= reach[r][:, None]) & (ids[own][None, :] != qid[r][:, None]))
                if not len(i):
                    continue
                cosine = np.einsum("ij,ij->i", q_unit[r[i]], unit[own][j])
                verified[r] += np.bincount(i, minlength=len(r))
                score[r[i], j + starts[leaf]] = cosine
                both = np.full((len(r), projected.shape[1] + k), -np.inf)
                both[:, projected.shape[1] :] = top[r]
                both[i, j] = cosine
                top[r] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            reach = reach_of(top.min(axis=1))
            begin += step
            step = max(1, -(-len(leaves) // ROUNDS))
        floor = top.min(axis=1) - EPS
        for j in range(len(q)):
            near = np.flatnonzero((score[j] >= floor[j]) & (score[j] > -np.inf))
            if len(near):
                exact = (vectors[near] * q[j]).sum(axis=1) / (norms[near] * q_norm[j])
                first = np.lexsort((ids[near], -exact))[:k]
                out += zip([int(qid[j])] * len(first), ids[near][first].tolist(), exact[first].tolist(), [None] * len(first), strict=True)
        out += [(int(a), None, None, int(n)) for a, n in zip(qid, verified, strict=True)]
    return out


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles), width: the rows that take part, once each."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine & F.exists("embedding", lambda x: x != 0.0))
    return rows.withColumn("width", F.size("embedding"))


def nearest(embeddings: DataFrame, every: int = 50, k: int = NEAREST) -> DataFrame:
    """The operator: query_id, rank, vec_id, score, verified for the rows whose vec_id is divisible by `every`."""
    rows = usable(embeddings)
    same = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = rows.dropDuplicates(["vec_id", "embedding"])
    index = materialize(distinct.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1).drop("place"), "vectors")
    queries = materialize(rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "embedding"]), "queries")
    out = None
    for width, n in sorted((r["width"], r["count"]) for r in index.groupBy("width").count().collect()):  # one entry for each length of vectors
        found = _nearest(index.filter(F.col("width") == width), queries.filter(F.col("width") == width), n, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, verified long")
    out = materialize(out, "found")
    verified = out.filter("vec_id is null").groupBy("query_id").agg(F.sum("verified").alias("verified"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = out.filter("vec_id is not null").drop("verified").dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(verified, "query_id").select("query_id", "rank", "vec_id", "score", "verified")


def _nearest(index: DataFrame, queries: DataFrame, n: int, k: int) -> DataFrame:
    sample = index.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("embedding").toArrow()
    points = project(matrix(sample.column("embedding")))
    tree = borders(points, min(MOST_CELLS, max(1, -(-n // PART_ROWS)), max(1, len(points) // 16)))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p = project(matrix(batch.column("embedding")))
            cols = [batch.column("vec_id"), batch.column("embedding"), pa.array(cell_of(p, tree)), *[pa.array(p[:, j]) for j in range(DIMS)]]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "embedding", "cell", *[f"p{j}" for j in range(DIMS)]])

    schema = "vec_id long, embedding array<double>, cell long, " + ", ".join(f"p{j} double" for j in range(DIMS))
    dealt = materialize(index.select("vec_id", "embedding").mapInArrow(deal, schema), "cells")
    boxes = dealt.groupBy("cell").agg(F.count("*").alias("n"), *[F.min(f"p{j}").alias(f"lo{j}") for j in range(DIMS)], *[F.max(f"p{j}").alias(f"hi{j}") for j in range(DIMS)]).orderBy("cell").collect()  # MOST_CELLS rows
    cells = np.array([b["cell"] for b in boxes])
    low, high = (np.array([[b[f"{end}{j}"] for j in range(DIMS)] for b in boxes]) for end in ("lo", "hi"))
    spark = index.sparkSession
    parts = F.broadcast(spark.createDataFrame([(int(b["cell"]), -(-b["n"] // PART_ROWS)) for b in boxes], "cell long, parts long"))  # MOST_CELLS rows
    stored = dealt.select("vec_id", "embedding", "cell").join(parts, "cell").select("vec_id", "embedding", "cell", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"))
    asked = queries.select("vec_id", "embedding").mapInArrow(deal, schema).select(F.col("vec_id").alias("query_id"), "embedding", F.col("cell").alias("home"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        got: list = []
        if left.num_rows and right.num_rows:
            got = search(matrix(left.column("embedding")), left.column("vec_id").to_numpy(), matrix(right.column("embedding")), right.column("query_id").to_numpy(), right.column("kth").to_numpy(), k)
        cols = list(zip(*got, strict=True)) or [[]] * 4
        types = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])

    def visit(wanted: DataFrame) -> DataFrame:
        """wanted: query_id, embedding, kth, cell."""
        block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
        seats = wanted.withColumn("block", block)
        spread = seats.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        keys = ["cell", "part", "block"]
        wanted_by = seats.select("cell", "block").distinct().toDF("_cell", "_block")
        met = stored.join(wanted_by, F.col("cell") == F.col("_cell")).select("vec_id", "embedding", "cell", "part", F.col("_block").alias("block"))
        return met.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(look, FOUND)

    home = materialize(visit(asked.select("query_id", "embedding", F.lit(float("-inf")).alias("kth"), F.col("home").alias("cell"))), "home")
    kth = home.filter("vec_id is not null").groupBy("query_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("score"), False).alias("best")).select("query_id", F.when(F.col("n") >= k, F.element_at("best", k)).alias("kth"))
    bounded = asked.join(kth, "query_id", "left").select("query_id", "embedding", "home", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            kth = batch.column("kth").to_numpy()
            reach = box_distance(project(matrix(batch.column("embedding"))), low, high)
            open_ = (reach <= reach_of(kth)[:, None]) & (cells[None, :] != batch.column("home").to_numpy()[:, None])
            q, c = np.nonzero(open_)
            at = pa.array(q)
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(at), batch.column("embedding").take(at), batch.column("kth").take(at), pa.array(cells[c])], names=["query_id", "embedding", "kth", "cell"])

    away = bounded.mapInArrow(route, "query_id long, embedding array<double>, kth double, cell long")
    return home.unionByName(visit(away)) if len(boxes) > 1 else home
