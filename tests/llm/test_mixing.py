"""Targets against water filling by repetition, streams against plain sums."""

import hashlib
import random
import re

import pytest

from lettermill.llm import mixing


def targets(sizes):
    """source: target, by resharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, capped, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            break
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            out |= {s: weight[s] * level for s in free}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        capped |= over
    return out


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def random_docs(seed, n=300):
    rng = random.Random(seed)
    sources = ["b", "a", "c", "\U0001f600", "￿", None, "hot", "hot", "hot", "tiny"]
    out = []
    for k in range(n):
        source = sources[min(rng.randrange(12), 9)]
        size = rng.randrange(5) if source == "tiny" else rng.choice([0, 1, 7, 40, 900 if rng.random() < 0.1 else 3])
        out.append((k, " ".join(["w"] * size) if size or rng.random() < 0.5 else None, source))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_takes(docs_of, seed):
    data = random_docs(seed)
    rows = mixing.mix(docs_of(data)).collect()
    sizes = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + words(text)
    goal = targets(sizes)
    by_id = {k: (text, source) for k, text, source in data}
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        text, source = by_id[r["doc_id"]]
        assert r["size"] == words(text) and r["source_size"] == sizes[source] and abs(r["target"] - goal[source]) <= 1e-9 * max(1, goal[source])
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["position"] is None) == (r["taken"] == 0 or r["position"] is None)
        assert r["position"] is None or 0 <= r["position"] <= 1
        taken[source] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)
    assert rows == mixing.mix(docs_of(data, parts=5)).collect()


def test_ranges_and_repeated_rows(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_BUCKET_ROWS", 4)
    data = [(1, "a b c", "x")] * 40 + [(k, "a " * (k % 9), "x") for k in range(60)] + [(None, "q r", "y"), (None, None, None)]
    rows = mixing.mix(docs_of(data)).collect()
    assert len(rows) == len(data)
    stream = sorted(((k if k is not None else None, words(t)) for k, t, s in data if s == "x"), key=lambda x: hashlib.md5(f"{x[0]}:{x[1]}".encode()).hexdigest())
    total, goal = sum(n for _, n in stream), int(next(r["target"] for r in rows if r["doc_id"] == 2))
    at, expected = 0, []
    for doc_id, n in stream:
        expected.append((doc_id, sum(max(0, min(n, goal - epoch * total - at)) for epoch in (0, 1))))
        at += n
    assert sorted(expected) == sorted((r["doc_id"], r["taken"]) for r in rows if r["source_size"] == total)


def test_nothing_to_take(docs_of):
    assert mixing.mix(docs_of([])).collect() == [] and mixing.mixed_documents(docs_of([])).collect() == []
    rows = mixing.mix(docs_of([None, "", " \n"])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 3


def test_schedule_inverts_its_integral(spark):
    from pyspark.sql import functions as F

    grid = [(u / 20, a) for u in range(21) for a in (-0.5, 0.0, 0.5)]
    for r in spark.createDataFrame(grid, "u double, a double").select("*", mixing.training_time(F.col("u"), F.col("a")).alias("t")).collect():
        assert abs(r["t"] + r["a"] * (r["t"] ** 2 - r["t"]) - r["u"]) < 1e-12


def test_mixed_documents_are_the_words_taken(docs_of):
    data = [(k, "\t".join(f"w{j}" for j in range(k % 11)) + "  end ", ("a", "b", None)[k % 3]) for k in range(60)] + [(3, "w0\tw1\tw2  end ", "a")]
    docs = docs_of(data)
    out = mixing.mixed_documents(docs)
    got = out.collect()
    assert out.columns == docs.columns
    texts = {k: t for k, t, _ in data}
    for r in got:
        assert texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) and r["size"] == -1
    by_source = {}
    for r in got:
        by_source[r["source"]] = by_source.get(r["source"], 0) + words(r["text"])
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + words(t)
    assert all(abs(by_source[s] - t) <= 1 for s, t in targets(sizes).items())


def test_very_many_copies_of_a_row(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 7)
    items = [(None, "", None)] * 30 + [(1, "a b c", "s")] * 40 + [(k, "w " * k, "t") for k in range(12)]
    a = sorted(map(str, mixing.mix(docs_of(items)).collect()))
    monkeypatch.setattr(mixing, "CHUNK", 4096)
    assert a == sorted(map(str, mixing.mix(docs_of(items)).collect())) and len(a) == 82
