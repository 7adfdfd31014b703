"""The classifier: held-out accuracy, no leaks, edge cases, and its parts against plain Python."""

import zlib

import numpy as np
import pytest

from lettermill.llm import quality
from lettermill.session import table

DATA = "/root/testdata/sf0.01"


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_rows_are_ranked_well(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    got = quality.classify(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    met = got.merge(labels.toPandas(), on="doc_id")
    held = met[met.held_out]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.9


def test_held_out_labels_do_not_matter(spark, docs_of, stored):
    texts = [("good words in a row " if k % 2 else "junk$$$ junk%%% ") * (k % 7 + 1) for k in range(120)]
    docs = docs_of([*texts, None, "", (None, "good words", "s"), (3, texts[3], "s")])
    told = [(k, k % 2, 0) for k in range(120)]
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, t) for k, q, t in told]
    schema = "doc_id long, quality int, toxic int"
    a, b = (quality.classify(docs, stored(x, schema)).toPandas().sort_values(["doc_id", "score"]) for x in (told, flipped))
    assert len(a) == 124 and np.allclose(a.score, b.score)
    held = a[a.held_out & (a.doc_id < 120)]
    assert (held.predicted == held.doc_id % 2).all()
    assert not a[a.doc_id.isna()].held_out.any()


@pytest.mark.parametrize("labels", [[], [(0, None, 0), (1, 7, 0)], [(k, 1, 0) for k in range(60)]])
def test_few_labels(docs_of, stored, labels):
    docs = docs_of(["a b c"] * 60)
    got = quality.classify(docs, stored(labels, "doc_id long, quality int, toxic int")).toPandas()
    assert len(got) == 60 and got.score.nunique() == 1 and got.score.between(0, 1).all()


def test_empty_table(docs_of, stored):
    labels = stored([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs_of([]), labels).collect() == []
    assert quality.keep_good(docs_of([]), labels).collect() == []


def test_word_table_sums_the_context_of_all_documents(docs_of):
    texts = ["a b c a", "b b", "", None, "x"]
    place, sign = quality.index_vectors()
    expected = np.zeros((quality.BUCKETS, quality.DIMS + 1))
    for text in texts:
        words = [zlib.crc32(w.encode()) % quality.BUCKETS for w in (text or "").split()]
        for i, w in enumerate(words):
            expected[w, quality.DIMS] += 1
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if i != j:
                    for k in range(quality.NONZERO):
                        expected[w, place[words[j], k]] += sign[words[j], k]
    assert np.array_equal(quality.word_table(docs_of(texts)), expected)


def test_temperature_is_fitted():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.train(x, y)
    score = net.score(x)
    for low, high in ((0.0, 0.3), (0.3, 0.7), (0.7, 1.0)):
        inside = (score >= low) & (score < high)
        assert abs(score[inside].mean() - y[inside].mean()) < 0.1
