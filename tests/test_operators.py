"""Copies, threads, pages, checks: small worked cases, and random graphs against union-find."""

import random

from pyspark.sql import functions as F

from lettermill.operators import dedup, pages, skew, threads, validate
from lettermill.operators.components import connected_components

COPY = "mid string, seq long, rank int, blob string, provenance string, full_sha string, body string"


def test_winner_is_best_rank_then_latest(rows):
    copies = rows([("m", 1, 3, "b1", "scrape", "s1", "text"), ("m", 2, 1, "b2", "maildir", "s2", "text more"), ("m", 3, 1, "b3", "maildir", "s3", "other"), ("n", 4, 3, "b4", "scrape", "s4", "x")], COPY)
    won = dedup.winners(copies)
    assert {(r["mid"], r["blob"]) for r in won.collect()} == {("m", "b3"), ("n", "b4")}
    lost = dedup.losers(copies, won)
    lists = {r["mid"]: [(x["blob"], x["provenance"]) for x in r["duplicates"]] for r in dedup.duplicate_lists(lost).collect()}
    assert lists == {"m": [("b2", "maildir"), ("b1", "scrape")]}
    assert [tuple(r) for r in dedup.conflicts(won, lost).collect()] == [("m", True)]


def test_keep_and_purge_sets(rows):
    copies = rows([("a", 1, True), ("a", 2, False), ("b", 3, True), ("c", 4, True), ("c", 5, True)], "mid string, seq long, s boolean")
    assert sorted(r["seq"] for r in dedup.keep_set(copies, F.col("s")).collect()) == [2, 3, 4, 5]
    assert [r["seq"] for r in dedup.purge_set(copies, F.col("s")).collect()] == [1]


def test_unseen_is_idempotent(rows):
    arriving = rows([("a", 1), ("a", 2), ("b", 3)], "mid string, seq long")
    known = rows([("b",)], "mid string", 1)
    assert [tuple(r) for r in dedup.unseen(arriving, known).collect()] == [("a", 1)]


def test_components_against_union_find(spark, rows):
    rng = random.Random(5)
    for n, m in ((1, 1), (30, 20), (200, 260)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(0, 0)]
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        touched = {x for a, b in edges if a != b for x in (a, b)}
        got = {r["node"]: r["component"] for r in connected_components(rows(edges, "src long, dst long")).collect()}
        assert got == {x: min(y for y in range(n) if find(y) == find(x)) for x in touched}


def test_whole_tables_are_compared(spark, tmp_path):
    from lettermill.plans import catalog

    rng = random.Random(6)
    lines = [(rng.randrange(300), 0 if rng.random() < 0.3 else rng.randrange(400), rng.randrange(1, 51)) for _ in range(900)] + [(1000 + k, 1000 + k // 2, 40) for k in range(20)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity long").write.parquet(f"{tmp_path}/lineitem.parquet")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for order, part, _ in lines:
        a, b = find(2 * order), find(2 * part + 1)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in catalog.queries()["g2_components"](spark, str(tmp_path)).collect()}
    assert got == {x: find(x) for x in list(parent)} and max(map(list(got.values()).count, set(got.values()))) > 400
    spark.createDataFrame([(k, f"text {k % 7}", f"src{k % 3}") for k in range(30)] + [(99, None, "src0")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "text 1"), (2, "text 2")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = sorted(r["doc_id"] for r in catalog.queries()["j5_all_diff_against"](spark, str(tmp_path)).collect())
    assert left == [k for k in range(30) if k % 7 not in (1, 2)] + [99]


def test_hot_keys_join_like_others(rows, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    left = rows([(k % 7 if k % 3 else 0, k) for k in range(300)], "k long, v long")
    right = rows([(k, k * k) for k in range(5)], "k long, w long")
    for limit in (1, 10, 1000):
        monkeypatch.setattr(skew, "HOT_KEYS", limit)
        got = sorted(tuple(r) for r in skew.join_unique(left, right, "k").select("k", "v", "w").collect())
        assert got == sorted((k, v, k * k) for k, v in ((k % 7 if k % 3 else 0, k) for k in range(300)) if k < 5)


def test_hubs_are_components_too(rows, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    edges = [(1000, k) for k in range(40)] + [(k, 100 + k) for k in range(0, 40, 2)] + [(500, 501)]
    got = {r["node"]: r["component"] for r in connected_components(rows(edges, "src long, dst long")).collect()}
    assert got == {**{x: 0 for e in edges[:-1] for x in e}, 500: 500, 501: 500}


def test_a_long_chain_is_one_component(rows):
    got = connected_components(rows([(k, k + 1) for k in range(100)], "src long, dst long"))
    assert got.select("component").distinct().count() == 1


THREAD = "mid string, irt string, refs array<string>, ts long"


def test_threads(rows):
    # b and c meet through a parent that was never stored; d and e reply to each other; f replies to itself.
    data = [("a", None, [], 5), ("b", "ghost", ["ghost"], 3), ("c", "ghost", [], 4), ("d", "e", [], 9), ("e", "d", [], 8), ("f", "f", [], 1), ("g", "a", ["a"], 2)]
    messages = rows(data, THREAD)
    labels = threads.thread_of(messages, threads.reply_edges(messages))
    roots = {r["mid"]: r["thread_root"] for r in threads.roots(messages, labels).collect()}
    assert roots == {"a": "a", "g": "a", "b": "b", "c": "b", "d": "e", "e": "e", "f": "f"}


def test_index_edges_join_threads(rows):
    messages = rows([("a", None, [], 1), ("b", None, [], 2), ("c", None, [], 3)], THREAD)
    index = rows([("a", 7), ("c", 7), ("unknown", 7)], "mid string, tid long")
    edges = threads.reply_edges(messages).unionByName(threads.index_edges(index, messages))
    roots = {r["mid"]: r["thread_root"] for r in threads.roots(messages, threads.thread_of(messages, edges)).collect()}
    assert roots == {"a": "a", "b": "b", "c": "a"}


def test_pages_to_messages(rows):
    url = "https://archive.example.org/list/2024/01/02/3"
    good = "<pre>\nMessage-ID: &lt;x@erqung.pbz&gt;\nFrom: me\n\nbody &amp; more\r\nline</pre>"
    got = {r["url"]: r for r in pages.page_messages(rows([(url, good), ("u2", "<p>"), ("u3", "<pre>From: x\n\nb</pre>"), ("u4", "<pre>no headers\n\nb</pre>")], "url string, html string")).collect()}
    assert (got[url]["mid"], got[url]["body"], got[url]["reason"], got[url]["date_made"]) == ("x@redhat.com", "body & more\nline", None, True)
    names = {h["name"]: h["value"] for h in got[url]["headers"]}
    assert names["Date"] == "Tue, 02 Jan 2024 12:00:00 +0000" and names["X-Archive-Source-URL"] == url and "Content-Type" in names
    assert [got[k]["reason"] for k in ("u2", "u3", "u4")] == ["no-pre-block", "no-message-id", "no-headers"]


def test_sanitized_bytes_keep_the_body(rows):
    raw = b"X-Spam: a\r\n folded\r\nReceived: from x by mail.hop.net; date\r\nSubject: caf\xe9\r\n\r\nX-Spam: body \xff\r\n"
    out = pages.raw_headers_and_body(rows([(1, bytearray(raw))], "seq long, raw binary", 1), r"hop\.net").first()
    assert bytes(out["clean"]) == b"Received: from x by mail.hop.net; date\r\nSubject: caf\xe9\r\n\r\nX-Spam: body \xff\r\n"
    assert out["proven"] and out["residual"] == []


def test_order_and_reference_checks(rows):
    lines = rows([("s", 0, "a", 1), ("s", 1, "b", 1), ("s", 2, "c", 0), ("t", 0, "d", 0)], "shard string, row long, id string, ts long")
    assert [r["id"] for r in validate.out_of_order(lines, "shard", "row", ["ts", "id"]).collect()] == ["c"]
    assert [r["id"] for r in validate.orphans(lines, rows([("a",), ("b",), ("d",)], "k string"), "id", "k").collect()] == ["c"]
    sides = validate.both_ways(rows([(1,), (2,)], "k long"), rows([(2,), (3,)], "k long"), ["k"])
    assert sorted(tuple(r) for r in sides.collect()) == [(1, "left"), (3, "right")]


def test_computed_tables_are_written_before_rows_are_numbered(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    from lettermill.session import rereadable

    rows([(k,) for k in range(50)], "k long").write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    for plain in (scan, scan.filter("k > 3").select((F.col("k") + 1).alias("k"))):
        assert rereadable(plain) is plain
    for computed in (scan.repartition(3), scan.filter(F.rand() < 0.5), scan.groupBy("k").count(), scan.join(scan, "k"), scan.limit(5), scan.withColumn("k", F.rand())):
        written = rereadable(computed)
        assert written is not computed and written.columns == computed.columns and rereadable(written) is written


def test_short_copies_differ_as_the_sql_says(spark, tmp_path):
    from lettermill.plans.catalog import queries

    texts = [(2, "x" * 190 + " ab@host.example.org and more"), (5, "y" * 200 + "   "), (3, "a" * 195 + "\n>>From b, and more"), (8, "short")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert dict(map(tuple, queries()["j16_prefix_pairs"](spark, str(tmp_path)).collect())) == {2: True, 5: True, 3: False, 8: False}


def test_bodies_and_messages_numbered_apart_meet_by_place(rows):
    from hashlib import sha256

    sha = lambda x: sha256(x.encode()).hexdigest()[:12]
    ids = [("2010", k, f"m{k}", f"b{k}") for k in range(5)]
    messages = rows([(s, 7 + 3 * k, m, sha(b)) for s, k, m, b in ids], "shard string, row long, message_id string, body_sha string")
    bodies = rows([(s, 100 + 2**33 * k, m, b) for s, k, m, b in ids], "shard string, row long, message_id string, body string")
    assert validate.check_bodies(messages, bodies).collect() == []
    assert [tuple(r) for r in validate.check_bodies(messages, bodies.filter("message_id <> 'm4'")).collect()] == [("V13", "2010", "m4", "message only")]
    assert [r["check"] for r in validate.check_bodies(messages, bodies.replace("b2", "b9", ["body"])).collect()] == ["V12"]
