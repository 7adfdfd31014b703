"""Fingerprints and components against brute force."""

import random
import re

import numpy as np
import xxhash

from lettermill.llm import simhash


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def near_texts(rng, n):
    words = ["w%d" % k for k in range(50)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.5:
            own = rng.choice(texts).split()
            own[rng.randrange(len(own))] = rng.choice(words)
        else:
            own = [rng.choice(words) for _ in range(rng.randrange(3, 120))]
        texts.append(" ".join(own))
    return texts


def test_against_brute_force(docs_of):
    rng = random.Random(1)
    texts = [*near_texts(rng, 150), None, "", " \n", "One two", "ONE\x0btwo", "É é", "é é", "a\xa0b c d e", "x " * 50]
    rows = simhash.near_duplicates(docs_of(texts)).collect()
    fps = [fingerprint(t) for t in texts]
    parts = components(fps)
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in rows}
    assert got == {k: (fps[k], parts[k]) for k in range(len(texts))}


def test_repeated_and_null_ids(docs_of):
    rows = simhash.near_duplicates(docs_of([(5, "a b c d e", "s"), (5, "a b c d e", "s"), (None, "a b c d e", "s"), (None, "other words here now", "s"), (9, "p q", "s")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in rows) == [("5", "5"), ("5", "5"), ("9", "9"), ("None", "5"), ("None", "None")]


def test_large_groups_in_tiles(spark, stored, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 10)
    monkeypatch.setattr(simhash, "FAN_TILES", 2)
    records = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(records, 7)
    try:
        large_groups(stored, monkeypatch)
    finally:
        spark.conf.unset(records)


def large_groups(stored, monkeypatch):
    rng = random.Random(3)
    fps = {0}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            fps.add(base)
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                base ^= 1 << bit
    fps = sorted(fps)
    for blocks in (5, 6, 7):
        monkeypatch.setattr(simhash, "blocks_for", lambda n, d, b=blocks: b)
        edges = simhash.links(stored([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")).collect()
        index = {f: k for k, f in enumerate(fps)}
        parent = list(range(len(fps)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in edges:
            a, b = (index[r[c] & (1 << 64) - 1] for c in ("src", "dst"))
            assert bin(fps[a] ^ fps[b]).count("1") <= 4
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
        assert [find(k) for k in range(len(fps))] == components(fps)


def test_index_finds_every_near_entry():
    rng = np.random.default_rng(4)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 63, 300).astype(np.uint64), np.uint64(1) << np.arange(60).astype(np.uint64)]))
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    got = {(int(q), int(e)) for qs, es in simhash.GrayIndex(fps).near(fps, 4) for q, e in zip(qs, es, strict=True)}
    expected = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4), strict=True)}
    assert got == expected
    ranks = [int(simhash.gray_rank(np.array([k ^ k >> 1], dtype=np.uint64))[0]) for k in range(64)]
    assert ranks == list(range(64))


def jaccard(a, b, n=5):
    x, y = ({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_texts_of_similar_shingles_are_one_group(docs_of):
    rng = random.Random(6)
    texts = []
    for _ in range(60):
        base = ["w%d" % rng.randrange(5000) for _ in range(rng.randrange(150, 600))]
        texts.append(" ".join(base))
        for share in (0.01, 0.02, 0.2):
            own = list(base)
            for at in rng.sample(range(len(own)), int(share * len(own)) or 1):
                own[at] = "x%d" % rng.randrange(5000)
            texts.append(" ".join(own))
    kept = {r["doc_id"] for r in simhash.keep_one(docs_of(texts)).collect()}
    for k in range(0, len(texts), 4):
        assert k in kept
        for j in (k + 1, k + 2):
            assert j not in kept or jaccard(texts[k], texts[j]) < 0.85
        assert k + 3 in kept and jaccard(texts[k], texts[k + 3]) < 0.5


def test_share_of_bits_follows_the_similarity():
    rng = random.Random(7)
    for share in (0.01, 0.02, 0.03):
        base = ["w%d" % rng.randrange(9000) for _ in range(3000)]
        own = list(base)
        for at in rng.sample(range(3000), int(3000 * share)):
            own[at] = "other"
        a, b = " ".join(base), " ".join(own)
        x, y = (np.frombuffer(simhash.wide_fingerprint(t.encode(), words=32), dtype="<u8") for t in (a, b))
        apart = int(np.bitwise_count(x ^ y).sum()) / 2048
        assert abs(apart - simhash.bits_apart(jaccard(a, b))) < 0.03


def test_one_document_of_each_group_stays(docs_of):
    docs = docs_of([(3, "a b c d e f", "s"), (1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (7, "quite another text of words", "s"), (None, "a b c d e f", "s"), (8, None, "s"), (9, "", "s")])
    kept = simhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 7, 8] and kept.columns == docs.columns
    assert kept.filter("fp != 'f'").count() == 0


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).collect() == [] and simhash.keep_one(docs_of([])).collect() == []
