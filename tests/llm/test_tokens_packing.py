"""Packing against the tokenizer and plain checks of a packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lettermill.llm import packing
from lettermill.llm.packing import best_fit, crossover, evolve, lower_bound, pack, pack_documents, token_pieces
from lettermill.llm.tokens import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "A<|endoftext|>b don't can't WE'LL", "Straße,. ÀÉ ÿß$$$ 12ab3 x9, ﬁ ǅ İstanbul", "a\x1cb\x85c\xa0d​e", "Σας ΣΑΣ", "x́ é, ≠ <|startoftext|>", "日本語, 한국어.", "µª ×÷ ½", "'s 's' it's,", "x" * 5000, "one two\tthree\nfour " * 3000]


def test_word_ids_equal_the_tokenizer():
    whole = Tokenizer.from_file(PATH)
    rng = random.Random(1)
    alphabet = "abcXYZ éßΩǅ٣9 .,;'!?$%<|>́‍\n\t\x0b\x1c\x85\xa0"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(500)]
    ours = WordIds(PATH).encode_all([t.encode() for t in texts])
    for text, raw in zip(texts, ours, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_long_texts_are_encoded_in_blocks(monkeypatch):
    from lettermill.llm import tokens

    rng = random.Random(2)
    texts = ["".join(rng.choice(["word ", "a\t", "é\n", "x" * 30, "\u00a0", "\x0b"]) for _ in range(200)) for _ in range(30)]
    whole = WordIds(PATH).encode_all([t.encode() for t in texts])
    monkeypatch.setattr(tokens, "BLOCK", 7)
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    assert WordIds(PATH).encode_all([t.encode() for t in texts]) == whole
    assert all(b"".join(tokens.blocks(t.encode())) == t.encode() for t in texts)


def test_many_empty_documents_end_with_the_lower_bound(spark, tmp_path):
    spark.range(10_000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN '' END AS text").write.parquet(f"{tmp_path}/d")
    rows = pack_documents(spark.read.parquet(f"{tmp_path}/d"), PATH).collect()
    assert len(rows) == 10_000 and {r["length"] for r in rows} == {1} and check(rows, 4096) == 3


def check(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for seats in places.values():
        at = 0
        for offset, length in sorted(seats):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_documents_are_cut_and_packed(docs_of):
    texts = [None, *ODD, "twice", "twice"]
    docs = docs_of([*[(k, t, "s") for k, t in enumerate(texts)], (1000, "same row", "s"), (1000, "same row", "s"), (None, "no id", "s")])
    rows = pack_documents(docs, PATH).collect()
    whole = Tokenizer.from_file(PATH)
    for k, text in enumerate(texts):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == k)
        assert mine == [(j, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for j, at in enumerate(range(0, len(ids), 4096))]
    assert Counter(r["doc_id"] for r in rows)[1000] == 2 and Counter(r["doc_id"] for r in rows)[None] == 1
    total = sum(r["length"] for r in rows)
    assert check(rows, 4096) == -(-total // 4096)


def test_empty_table(docs_of):
    assert pack_documents(docs_of([]), PATH).collect() == []
    assert token_pieces(docs_of([]), PATH).collect() == []


def test_levels_and_islands(stored, monkeypatch):
    monkeypatch.setattr(packing, "GENERATIONS", 3)
    rng = random.Random(3)
    lengths = [rng.choice([35, 34, 31, 27, 52, 48, 66, 9]) for _ in range(400)]
    pieces = stored([(k, 0, 0, n, k) for k, n in enumerate(lengths)], packing.PIECE_SCHEMA)
    rows = pack(pieces, capacity=100, shard_items=60).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(400))
    assert check(rows, 100) <= 1.06 * sum(lengths) / 100 + 2


def test_shards_of_very_small_pieces(stored):
    for n, length in ((150, 1), (4000, 1), (700, 2)):
        rows = pack(stored([(k, 0, 0, length, k) for k in range(n)], packing.PIECE_SCHEMA), capacity=100, shard_items=60).collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(n))
        assert check(rows, 100) == -(-n * length // 100)


def test_genetic_steps_keep_every_item_once():
    rng = random.Random(4)
    for _ in range(30):
        lens = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 50))]
        parents = []
        for _ in range(2):
            order = list(range(len(lens)))
            rng.shuffle(order)
            bins, loads = [], []
            best_fit(bins, loads, order, lens, 60)
            parents.append(bins)
        bins, loads = crossover(parents[0], parents[1], lens, 60, rng)
        assert sorted(i for b in bins for i in b) == list(range(len(lens)))
        assert loads == [sum(lens[i] for i in b) for b in bins] and max(loads) <= 60
        out = evolve(lens, 60, [], 1, 4, 3)
        assert max(Counter(np.repeat(out, lens).tolist()).values()) <= 60 and len(set(out)) >= lower_bound(lens, 60)


def test_evolution_beats_decreasing_order():
    lens = [44, 44, 44, 6, 6, 24, 24, 24, 24, 24, 24, 30, 30, 30, 30, 21, 21, 21, 21, 8, 8, 8] * 3
    founder = max(evolve(lens, 100, [], 1, 1, 0)) + 1
    evolved = max(evolve(lens, 100, [], 1, 8, 40)) + 1
    assert lower_bound(lens, 100) <= evolved <= founder
