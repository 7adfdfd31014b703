"""Nearest neighbours against brute force."""

import math

import numpy as np

from lettermill.llm import neighbours
from lettermill.session import table

SCHEMA = "vec_id long, embedding array<float>, label int, score double, cell long"


def brute(vectors, every=50, k=5):
    """query: [(vec_id, score)], ties to the smaller id."""
    fine = {i: np.array(v, dtype=np.float32).astype(float) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in (i for i in fine if i % every == 0):
        near = [(-(fine[q] * v).sum() / math.sqrt((fine[q] ** 2).sum()) / math.sqrt((v**2).sum()), i) for i, v in fine.items() if i != q and len(v) == len(fine[q])]
        out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in near)[:k]]
    return out


def run(stored, vectors):
    got = {}
    df = stored([(i, v, 0, 1.0, 2) for i, v in vectors], SCHEMA)
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return got


def same(got, expected):
    assert got.keys() == {q for q, near in expected.items() if near}
    for q, near in expected.items():
        assert [x[0] for x in got.get(q, [])] == [x[0] for x in near]
        assert np.allclose([x[1] for x in got.get(q, [])], [x[1] for x in near], atol=1e-12)
        assert [x[2] for x in got.get(q, [])] == list(range(1, len(near) + 1))


def test_recall(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    vectors = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    expected = brute(vectors)
    got = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & {i for i, _ in near}) for q, near in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_cells_parts_and_blocks(stored, monkeypatch):
    for name, value in (("PART_ROWS", 40), ("QUERY_BLOCK", 3), ("LEAF", 4), ("SAMPLE_ROWS", 200)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 12))
    vectors = [(k, (centres[k % 8] + 0.05 * rng.normal(size=12)).tolist()) for k in range(500)]
    expected, got = brute(vectors), run(stored, vectors)
    hits = sum(len({x[0] for x in got[q]} & {i for i, _ in near}) for q, near in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_ties_copies_and_vectors_that_take_no_part(stored):
    nan, inf = float("nan"), float("inf")
    vectors = [(k, [1.0, 2.0]) for k in range(0, 130)] + [(200, [1.0, 0.0]), (250, [0.0, 0.0]), (300, None), (350, [nan, 1.0]), (400, [inf, 1.0]), (450, []), (500, [None, 1.0]), (None, [1.0, 1.0]), (550, [1.0, 2.0, 3.0])]
    same(run(stored, [*vectors, (7, [1.0, 2.0]), (50, [1.0, 2.0])]), brute(vectors))


def test_an_index_prunes(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    n = df.count()
    rows = neighbours.nearest(df).groupBy("query_id").agg({"verified": "max"}).collect()
    assert sum(r[1] for r in rows) < 0.5 * n * len(rows) and all(r[1] >= 5 for r in rows)


def test_squares_that_overflow_or_vanish(spark, tmp_path):
    vectors = [(0, [3e200, 4e200]), (1, [3e-200, 4e-200]), (2, [4.0, 3.0]), (3, [-1e300, 1e-300]), (50, [5e-324, 0.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/v")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 9)) for r in neighbours.nearest(spark.read.parquet(f"{tmp_path}/v")).collect()}
    assert [got[0, k] for k in range(1, 5)] == [(1, 1.0), (2, 0.96), (50, 0.6), (3, -0.6)]
    assert [got[50, k][0] for k in range(1, 5)] == [2, 0, 1, 3]


def test_few_and_none(stored):
    same(run(stored, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])]), brute([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])]))
    assert run(stored, [(0, [1.0, 0.0])]) == {} and run(stored, []) == {}


def test_stopping_test_is_the_chi_square_distribution():
    rng = np.random.default_rng(1)
    sample = (rng.normal(size=(200_000, neighbours.DIMS)) ** 2).sum(axis=1)
    for x in (2.0, 8.0, 15.0):
        assert abs(neighbours.within(np.array([x]))[0] - (sample <= x).mean()) < 0.005
