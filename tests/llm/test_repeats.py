"""Repeated strings against brute force, and suffix sorting with queues on disk."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from lettermill.llm import repeats
from lettermill.llm import suffixes as sorting


def brute(docs, length=50):
    """Sorted rows of doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rank = lambda i: (i is None, i if i is not None else 0)
    owner = {}
    for i, text in docs:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1):
            s = raw[k : k + length]
            owner[s] = min(owner.get(s, rank(i)), rank(i))
    out = []
    for i, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - length + 1):
            if owner[raw[k : k + length]] < rank(i):
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = int(np.sum(gone & ~np.append(False, gone[:-1]))) if len(raw) else 0
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs_of, docs, **settings):
    return sorted((tuple(r) for r in repeats.remove_repeats(docs_of([(i, t, "s") for i, t in docs]), **settings).collect()), key=str)


def test_against_brute_force(docs_of):
    rng = random.Random(1)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randrange(20, 90))) for _ in range(12)]
    docs = [(k, "".join(rng.choice([*pool, "q" * 30, "xyz", str(rng.random())]) for _ in range(rng.randrange(8)))) for k in range(60)]
    docs += [(100, None), (101, ""), (102, "a" * 49), (103, "a" * 50), (104, "a" * 300), (105, "a" * 60), (None, docs[5][1] * 2), (106, docs[5][1]), (106, docs[5][1]), (107, "ab" * 200), (108, "ba" * 200)]
    for settings in ({}, {"bucket_text": 500}):
        assert run(docs_of, docs, **settings) == brute(docs)


def test_long_texts_over_stretches(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 300)
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    docs = [(1, long), (2, long[100:900] + "!" + long[50:200]), (3, "new " + long[2900:] + long[:60]), (4, long)]
    assert run(docs_of, docs) == brute(docs)


def test_empty_table(docs_of):
    assert run(docs_of, []) == []


def order_of(text, depth, memory):
    at, common = [], []
    sorting.suffixes(text, depth, lambda a, c: (at.extend(a.tolist()), common.extend(c.tolist())), memory)
    return at, common


def test_suffixes_and_common_prefixes_with_memory_below_the_text(monkeypatch):
    rng = np.random.default_rng(1)
    whole = sorting.BLOCK
    for _ in range(400):
        monkeypatch.setattr(sorting, "BLOCK", int(rng.choice([1, 3, 7, whole])))
        n, depth = int(rng.integers(1, 80)), int(rng.choice([1, 2, 5, 10, 100]))
        text = [rng.integers(0, int(rng.integers(1, 5)), n), np.tile(rng.integers(0, 4, rng.integers(1, 6)), 40)[:n], np.repeat(rng.integers(0, 4, n), rng.integers(1, 30, n))[:120]][int(rng.integers(3))].astype(rng.choice([np.uint8, np.uint16]))
        t = text.tolist()
        for memory in (64, 600, 1 << 20):
            at, common = order_of(text, depth, memory)
            assert sorted(at) == list(range(len(t)))
            for k in range(1, len(at)):
                x, y = t[at[k - 1] : at[k - 1] + depth], t[at[k] : at[k] + depth]
                same = next((j for j, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))
                assert x >= y and common[k] == same


def test_memory_stays_flat_as_the_text_grows(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(sorting, "BLOCK", 4096)
    rng = np.random.default_rng(5)
    peaks = []
    for n in (300_000, 1_200_000):
        text = rng.integers(97, 105, n).astype(np.uint8)
        text[n // 2 : n // 2 + 5000] = text[:5000]
        tracemalloc.start()
        sorting.suffixes(text, 50, lambda a, c: None, 1 << 20)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0]


def test_least_owners_with_every_byte_in_use():
    rng = random.Random(3)
    texts = [bytes(range(256)) * 2, *[bytes(rng.randrange(2) for _ in range(rng.randrange(50, 90))) for _ in range(30)]]
    texts += [t[:60] for t in texts]
    starts, owners, at = [], [], 0
    least = {}
    for k, t in enumerate(texts):
        for j in range(len(t) - 49):
            starts.append(at + j)
            owners.append(1000 - k)
            least[t[j : j + 50]] = min(least.get(t[j : j + 50], 10**6), 1000 - k)
        at += len(t) + 1
    got = repeats.least_owners(repeats.joined(texts), np.array(starts), np.array(owners))
    assert got.tolist() == [least[t[j : j + 50]] for t in texts for j in range(len(t) - 49)]


def test_shards_smaller_than_a_partition(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_TEXT", 400)
    rng = random.Random(7)
    pool = ["".join(rng.choice("abcd ") for _ in range(70)) for _ in range(6)]
    docs = [(k, "".join(rng.choice(pool) for _ in range(rng.randrange(5)))) for k in range(40)]
    assert run(docs_of, docs, bucket_text=700) == brute(docs)


def test_of_fragments_with_one_key_only_strings_that_occur_twice_are_sorted(monkeypatch):
    rng = random.Random(11)
    words = ["harvest", "lantern", "meadows", "orchard", "quarrel", "village", "whisper", "yonder"]
    docs = [" ".join(rng.choice(words) for _ in range(30)).encode() for _ in range(60)]
    docs.append(docs[0][20:150] + b"!" + docs[1][:90])
    _, data, bounds = next(repeats.stretches(docs))
    doc, start, count, _ = repeats.runs(data, bounds)
    raw, owner = data.tobytes(), {}
    for d, a, n in zip(doc.tolist(), start.tolist(), count.tolist(), strict=True):
        piece = raw[a : a + n + 49]
        owner[piece] = min(owner.get(piece, 1000), 1000 - d)
    packed = [repeats._pack(np.array([len(x) for x in owner], dtype="<u4")), repeats.zstandard.compress(b"".join(owner)), repeats._pack(np.array(list(owner.values()), dtype="<i8"))]
    table = pa.table({"bucket": pa.array([0], pa.int32()), "shard": [0], "sizes": [packed[0]], "text": [packed[1]], "least": [packed[2]]})
    asked, least_owners = [], repeats.least_owners
    monkeypatch.setattr(repeats, "least_owners", lambda text, starts, owners: asked.append(len(starts)) or least_owners(text, starts, owners))
    answer = repeats._answer_fragments(table)
    at, least = (repeats._unpack(answer.column(c)[0].as_py(), "<i8") for c in ("at", "least"))
    strings = [(x[k : k + 50], i) for x, i in owner.items() for k in range(len(x) - 49)]
    best = {}
    for x, i in strings:
        best[x] = min(best.get(x, i), i)
    assert np.repeat(least, np.diff(at)).tolist() == [best[x] for x, _ in strings]
    times = Counter(x for x, _ in strings)
    assert 0 < sum(asked) == sum(n for n in times.values() if n > 1) < len(strings) / 2


def test_keys_are_equal_for_equal_strings():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, 4000).astype(np.uint8)
    keys = repeats.string_keys(data)
    assert len(keys) == 4000 - 49
    seen = {}
    for k in range(len(keys)):
        assert seen.setdefault(data[k : k + 50].tobytes(), keys[k]) == keys[k]
    copy = np.concatenate([data[:7], data[100:200]])
    assert repeats.string_keys(copy)[7:].tolist() == keys[100:151].tolist()
