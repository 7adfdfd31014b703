"""Merkle trees: equality, likeness, the place of an edit, and neighbours against plain Python."""

import hashlib
import random
from collections import Counter

from lettermill.llm import merkle


def near(a, b):
    return merkle.likeness(a.fingerprint(), b.fingerprint())


def prose(rng, n):
    return "".join(rng.choice(["alpha ", "beta ", "gamma, ", "delta.\n", "épsilon ", "\n\n", "zeta"]) + str(rng.randrange(99)) for _ in range(n))


def plain_likeness(a, b):
    """Dice of the bytes in equal pieces, told apart by the piece before, from the texts alone."""
    if a == b:
        return 1.0
    bags = []
    for text in (a, b):
        ends = merkle._cuts(text.encode()).tolist()
        pieces = [text.encode()[x:y] for x, y in zip([0, *ends], ends)]  # noqa: B905
        bags.append(Counter(zip([b"", *pieces], pieces)))  # noqa: B905
    size = lambda bag: sum(n * len(x[1]) for x, n in bag.items())
    return 2 * size(bags[0] & bags[1]) / (size(bags[0]) + size(bags[1]))


def test_neighbours_against_python(docs_of, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 7)
    rng = random.Random(1)
    items = [(k * 3, prose(rng, rng.randrange(40)), "s") for k in range(50)] + [(200, None, "s"), (201, "", "s"), (202, "one", "s"), (203, "same text", "s"), (204, "same text", "s"), (None, "first of all", "s"), (203, "same text", "s")]
    rows = merkle.compare_neighbours(docs_of(items)).collect()
    ordered = sorted(((i, t or "") for i, t, _ in items), key=lambda x: (x[0] is not None, x[0] or 0))
    expected, near = [], {}
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b = (str(merkle.build(x.encode()).fingerprint()) for x in (text, edited))
        expected.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b))
        near[i] = (plain_likeness(text, edited), plain_likeness(text, following)) if i != 203 else None
    assert sorted(map(str, expected)) == sorted(str(tuple(r)[:5]) for r in rows)
    for r in rows:
        said = [merkle.likeness(merkle.Fingerprint.parse(r["fingerprint"]), merkle.Fingerprint.parse(r["edited_fingerprint"])), r["near_next"]]
        assert r["near_edited"] == said[0]
        assert near[r["doc_id"]] is None or all(abs(x - y) < 1e-9 for x, y in zip(said, near[r["doc_id"]], strict=True))


def test_many_equal_rows_and_null_ids(docs_of, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 5)
    rng = random.Random(8)
    other = [prose(rng, 5) for _ in range(20)]
    rows = merkle.compare_neighbours(docs_of([(None, "a copy", "s")] * 40 + [(None, t, "s") for t in other] + [(9, "a copy", "s")] * 30)).collect()
    assert Counter(r["doc_id"] for r in rows) == {None: 60, 9: 30}
    assert sum(r["near_next"] == 1.0 for r in rows) >= 39 + 29
    by_text = Counter(r["fingerprint"] for r in rows)
    assert sorted(by_text.values()) == [1] * len(set(other)) + [70]


def test_sampled_leaves_tell_the_likeness_of_long_texts():
    rng = random.Random(9)
    words = ["word%d" % k for k in range(3000)]
    for share in (0.1, 0.5, 0.9):
        a = " ".join(rng.choice(words) for _ in range(4000))
        cut = int(len(a) * share)
        b = a[:cut] + " " + " ".join(rng.choice(words) for _ in range(int(4000 * (1 - share))))
        x, y = (merkle.build(t.encode()).fingerprint() for t in (a, b))
        assert len(x.leaves) == merkle.MOST_LEAVES and len(str(x)) < 4000
        assert abs(merkle.likeness(x, y) - plain_likeness(a, b)) < 0.15


def test_one_and_none(docs_of):
    row = merkle.compare_neighbours(docs_of([(4, "abcd", "s")])).first()
    assert (row["n_chars"], row["near_next"], row["edited_sha256"]) == (4, 1.0, hashlib.sha256(b"abab").hexdigest())
    assert merkle.compare_neighbours(docs_of([])).collect() == []


def test_equal_texts_alone_have_equal_fingerprints():
    rng = random.Random(2)
    texts = {prose(rng, rng.randrange(30)) for _ in range(300)} | {"", "\n", "\n\n", " ", "a", "a\n", "a\n\n", "ab", "a b"}
    prints = {str(merkle.build(t.encode()).fingerprint()) for t in texts}
    assert len(prints) == len(texts)
    assert all(merkle.build(t.encode()).root == merkle.build(t.encode()).root for t in texts)


def test_a_tree_holds_the_whole_text():
    rng = random.Random(3)
    for n in (0, 1, 5, 200):
        text = prose(rng, n).encode()
        tree = merkle.build(text)
        assert sum(tree.piece_sizes) == sum(tree.paragraph_sizes) == tree.size == len(text)


def test_likeness_and_place_of_an_edit():
    rng = random.Random(4)
    a = prose(rng, 400).encode()
    b = a[:2000] + b"CHANGED WORDS" + a[2000:]
    x, y = merkle.build(a), merkle.build(b)
    assert 0.9 < near(x, y) < 1 and near(x, y) == near(y, x)
    start, end = merkle.edited_range(x, y)
    assert start <= 2000 <= end and end - start < 400
    assert near(x, merkle.build(prose(random.Random(9), 3).encode() + b"zzz")) < 0.1
    assert near(merkle.build(b""), merkle.build(b"")) == 1.0 and near(x, merkle.build(b"")) == 0.0


def test_texts_on_either_side_of_a_length_limit():
    rng = random.Random(5)
    for limit, words in ((512, 60), (4096, 600)):
        for line in (b" ", b"\n"):
            a = b"".join(b"w%d" % rng.randrange(10**6) + (line if k % 9 == 8 else b" ") for k in range(words * 2))[: limit - 6]
            b = a + b" " + b"tail" * 5
            assert len(a) < limit < len(b)
            x, y = merkle.build(a), merkle.build(b)
            assert near(x, y) == near(y, x) > 0.9
            assert merkle.edited_range(x, y)[0] > limit - 100
            assert x.paragraphs[:-1] == y.paragraphs[: len(x.paragraphs) - 1]


def test_texts_without_spaces():
    rng = random.Random(6)
    kinds = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(900)), "".join(rng.choice("abcdefABCDEF0123456789+/") for _ in range(3000)), "\t".join(str(rng.randrange(10**6)) for _ in range(400)), "\r".join(str(rng.randrange(10**6)) for _ in range(400)), "x" * 3000]
    for text in kinds:
        half = len(text) // 2
        a, b = merkle.build(text.encode()), merkle.build((text[:half] + "EDIT" + text[half:]).encode())
        assert 0.8 < near(a, b) < 1
        start, end = merkle.edited_range(a, b)
        at = len(text[:half].encode())
        assert start <= at <= end and (end - start < 600 or text[:9] == "x" * 9)  # a run of one byte has no place to cut by
        assert max(a.piece_sizes) <= 256 and sum(a.piece_sizes) == a.size
        c = merkle.build((text[: len(text) - half] + "other words " * 200)[: len(text)].encode())
        assert 0.3 < near(a, c) < 0.8
