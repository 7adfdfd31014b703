"""The pipeline: each stage's decisions against plain code, then the whole; and the part without this package."""

import re
import zlib

import corpus_pipeline
from lettermill.llm import quality
from lettermill.llm.simhash import WIDE, bits_allowed, wide_fingerprint

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.materialize(stage(spark, before, DATA), f"test-{name}")
        rows, was = path.collect(), before.collect()
        if name != "best_fit_packing":
            assert path.columns == docs.columns
        if name == "quality_classifier":
            score = quality.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))
            kept = sorted(r["doc_id"] for r, s in zip(was, score(r["text"].encode() for r in was), strict=True) if s >= 0.3)
            assert sorted(r["doc_id"] for r in rows) == kept and 0 < len(kept) < len(was)
        if name == "simhash_near_dedup":
            fps = {r["doc_id"]: int.from_bytes(wide_fingerprint(r["text"].encode()), "little") for r in was}
            most, left = bits_allowed(0.8, WIDE), {r["doc_id"] for r in rows}
            assert all((fps[a] ^ fps[b]).bit_count() > most / 2 for a in left for b in left if a < b)  # nearer ones meet for sure, or nearly
            assert all(any((fps[i] ^ fps[j]).bit_count() <= most for j in fps if j != i) for i in fps.keys() - left)
            words = {r["doc_id"]: r["text"].split() for r in was}
            sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
            alike = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.85 * len(sets[a] | sets[b])]
            assert sum(a in left and b in left for a, b in alike) <= 0.1 * len(alike)
        if name == "secret_scans":
            texts = {r["doc_id"]: r["text"] for r in rows}
            assert not any(re.search("AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", t) for t in texts.values())
            assert len(texts) == len(was) and all(r["text"] == texts[r["doc_id"]] or "[REDACTED]" in texts[r["doc_id"]] for r in was)
        if name == "mixing":
            size = lambda rs: sum(len(r["text"].split()) for r in rs)
            assert abs(size(rows) - 1.5 * size(was)) < 30
        if name == "best_fit_packing":
            assert sum(r["length"] for r in rows) <= 4096 * len({r["sequence_id"] for r in rows})
        before = path


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    again = corpus_pipeline.run(spark, DATA).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert rows and sorted(map(key, rows)) == sorted(map(key, again))


def test_stages_on_odd_documents(spark, docs_of, tmp_path):
    texts = [None, "", "a", "password: hunter2hunter2 " * 50, "one two three four five six " * 900, (1, "a", None), (1, "a", None), (None, None, None)]
    docs = docs_of([x if isinstance(x, tuple) else (k, x, "s") for k, x in enumerate(texts)])
    spark.createDataFrame([(zlib.crc32(b"x") % 7, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = corpus_pipeline.materialize(stage(spark, table, str(tmp_path)), f"odd-{name}")
            if name != "best_fit_packing":
                assert table.columns == docs.columns


def test_every_operator_is_registered():
    names = entry.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in names if n.startswith("op")} == {str(k) for k in range(1, 11)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
