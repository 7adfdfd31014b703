"""From a git log of raw mail to a published, checked index, twice the same."""

import hashlib
import json
import os
import subprocess

import pytest
from pyspark.sql import functions as F

from lettermill.operators import validate
from lettermill.plans.index import build
from lettermill.profile import Profile
from lettermill.sinks.export import export, newest_ts, status_document
from lettermill.sources import archive, shards

PROFILE = Profile(source="list", hop=r"hop\.net", day_url="'https://archive.example.org/list/'yyyy/MM/dd")


def mail_of(mid, body, date="Mon, 01 Jan 2024 10:00:00 +0000", **more):
    lines = [f"Message-ID: <{mid}>"] if mid else []
    lines += [f"Date: {date}", "From: Someone <a@b.org>", "Subject: About CVE-2023-11111"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items()]
    return ("\n".join(lines) + "\n\n" + body).encode()


MESSAGES = [
    mail_of("one@x", "first, CVE-2024-1234\n"),
    mail_of("one@x", "first, CVE-2024-1234\nfooter", X_Archive_Source="scrape", X_Archive_Source_URL="https://archive.example.org/list/2024/01/01/7"),
    mail_of("two@x", "reply GHSA-2whq-6rcm-64m8", "Tue, 02 Jan 2024 10:00:00 +0000", In_Reply_To="<one@x>"),
    mail_of("three@x", "future", "Tue, 02 Jan 2030 10:00:00 +0000", Received="from a by mail.hop.net; Wed, 03 Jan 2024 10:00:00 +0000"),
    mail_of(None, "nameless", "Thu, 04 Jan 2024 10:00:00 +0000"),
    mail_of("bad@x", "to be removed"),
]


@pytest.fixture(scope="module")
def inbox(tmp_path_factory):
    home = tmp_path_factory.mktemp("inbox")
    repo = home / "git" / "0.git"
    env = os.environ | {"GIT_AUTHOR_NAME": "x", "GIT_AUTHOR_EMAIL": "x@x", "GIT_COMMITTER_NAME": "x", "GIT_COMMITTER_EMAIL": "x@x", "GIT_AUTHOR_DATE": "1704500000 +0000", "GIT_COMMITTER_DATE": "1704500000 +0000"}
    subprocess.run(["git", "init", "-q", "--bare", "-b", "master", repo], check=True)
    git = lambda *a, data=None: subprocess.run(["git", "-C", repo, *a], input=data, capture_output=True, check=True, env=env).stdout.strip().decode()
    parent = []
    for path, raw in [*[("m", m) for m in MESSAGES], ("d", MESSAGES[-1])]:
        blob = git("hash-object", "-w", "--stdin", data=raw)
        tree = git("mktree", data=f"100644 blob {blob}\t{path}\n".encode())
        commit = git("commit-tree", tree, *parent, "-m", "x")
        parent = ["-p", commit]
        git("update-ref", "refs/heads/master", commit)
    return str(home)


def published(spark, inbox, out):
    index = build(archive.stored_messages(spark, inbox), PROFILE)
    return index, export(index, f"file://{out}", "list", {"0": "c"}, 1704600000)


def read(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in sorted(path.rglob("*")) if p.is_file() and not p.name.startswith(".")}


def test_log_is_read_in_order_and_removals_drop_blobs(spark, inbox):
    got = archive.stored_messages(spark, inbox).orderBy("seq").collect()
    assert [bytes(r["raw"]) for r in got] == MESSAGES[:-1]
    assert all(hashlib.sha1(b"blob %d\0" % len(r["raw"]) + bytes(r["raw"])).hexdigest() == r["blob"] for r in got)


def test_a_log_is_read_in_ranges_and_a_lost_commit_is_an_error(spark, inbox):
    spark.dataSource.register(archive.EpochLog)
    whole = spark.read.format("epoch_log").load(inbox).orderBy("seq").collect()
    parts = spark.read.format("epoch_log").option("commits", 2).load(inbox)
    assert parts.rdd.getNumPartitions() == 4 and parts.orderBy("seq").collect() == whole
    reader = archive.EpochReader(inbox, "master", 100)
    part = reader.partitions()[-1]
    part.last, part.total = part.last + 1, part.total + 1
    with pytest.raises(OSError, match="of 8"):
        list(reader.read(part))
    stored = archive.stored_messages(spark, inbox)
    assert archive.lost_messages(stored, stored).count() == 0
    assert archive.lost_messages(stored, stored.filter("seq > 8")).count() == 2


def test_thread_index_of_the_newest_database(spark, tmp_path):
    import sqlite3
    import zlib

    data = lambda mid: zlib.compress("\n".join(["s", "f", "r", "t", "c", "b", mid, "1", "2"]).encode())
    for name, rows in (("xap15", [(1, 9, data("old@x"))]), ("xap16", [(0, 1, data("zero@x")), (1, 7, data("a@x")), (2, 7, data("b@x")), (3, 8, b"junk"), (60_000, 8, data("c@x"))])):
        (tmp_path / name).mkdir()
        with sqlite3.connect(tmp_path / name / "over.sqlite3") as db:
            db.execute("CREATE TABLE over (num INTEGER, tid INTEGER, ddd BLOB)")
            db.executemany("INSERT INTO over VALUES (?, ?, ?)", rows)
    got = archive.thread_index(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("a@x", 7), ("b@x", 7), ("c@x", 8)]
    (tmp_path / "xap16/over.sqlite3").write_text("no database")
    assert archive.thread_index(spark, str(tmp_path)).count() == 0
    assert archive.thread_index(spark, f"{tmp_path}/none").count() == 0


def test_index(spark, inbox, tmp_path):
    index, manifest = published(spark, inbox, tmp_path / "a")
    assert (manifest["total_stored"], manifest["total_messages"], manifest["total_cves"], manifest["total_ghsas"]) == (5, 4, 2, 1)
    lines = [json.loads(x) for x in (tmp_path / "a/messages/2024.jsonl").read_text().splitlines()]
    assert [m["message_id"] for m in lines[:3]] == ["one@x", "two@x", "three@x"] and lines[3]["synthetic_mid"]
    one, two, three = lines[:3]
    assert [x["provenance"] for x in one["duplicates"]] == ["scrape"] and one["provenance"] == "maildir" and not one["body_conflict"]
    assert one["url"].endswith("/7") and two["url"].endswith("/2024/01/02")
    assert two["thread_root"] == "one@x" and two["in_reply_to"] == "one@x"
    assert (three["date"], three["date_source"]) == ("2024-01-03T10:00:00Z", "received")
    ids = json.loads((tmp_path / "a/cves/2024.json").read_text())
    assert list(ids) == ["CVE-2024-1234"] and ids["CVE-2024-1234"][0]["message_id"] == "one@x"
    bodies = [json.loads(x) for x in (tmp_path / "a/bodies/2024.jsonl").read_text().splitlines()]
    assert [b["message_id"] for b in bodies] == [m["message_id"] for m in lines]
    status = status_document({}, manifest, True, 1704700000, newest_ts(index.messages))
    assert status["counts"] == {"messages": 4, "stored": 5, "duplicates": 1} and status["freshness"]["source_lag_s"] == 1704700000 - 1704362400


def test_a_second_run_gives_the_same_bytes(spark, inbox, tmp_path):
    published(spark, inbox, tmp_path / "a")
    (tmp_path / "b/messages").mkdir(parents=True)
    (tmp_path / "b/messages/1999.jsonl").write_text("stale\n")
    published(spark, inbox, tmp_path / "b")
    assert read(tmp_path / "a") == read(tmp_path / "b")


def violations(spark, out):
    where = f"file://{out}"
    messages, bodies = shards.read_lines(spark, where, "messages"), shards.read_lines(spark, where, "bodies")
    checks = validate.check_messages(messages).unionByName(validate.check_bodies(messages, bodies))
    for kind in ("cves", "ghsas"):
        checks = checks.unionByName(validate.check_mentions(shards.read_mentions(spark, where, kind), messages, kind))
    manifest = shards.read_document(spark, f"{where}/manifest.json")
    checks = checks.unionByName(validate.check_manifest(shards.manifest_rows(spark, manifest), shards.measured_files(spark, where)))
    return {r["check"] for r in checks.select("check").distinct().collect()}


def test_checks_pass_and_find_damage(spark, inbox, tmp_path):
    out = tmp_path / "a"
    published(spark, inbox, out)
    assert violations(spark, out) == set()
    rounds = (
        (
            ("messages/2024.jsonl", '"date_source":"received"', '"date_source":"guess"', "V10"),
            ("messages/2024.jsonl", '"date":"2024-01-02', '"date":"2023-01-02', "V7"),
            ("bodies/2024.jsonl", "future", "futures", "V12"),
            ("cves/2024.json", "CVE-2024-1234", "CVE-2025-1234", "V14"),
            ("ghsas/all.json", "GHSA-2whq", "GHSA-2WHQ", "V17"),
        ),
        (
            ("messages/2024.jsonl", '"message_id":"two@x"', '"message_id":"one@x"', "V6"),
            ("messages/2024.jsonl", '"date":"2024-01-02', '"date":"2024-02-02', "V8"),
            ("cves/2024.json", "one@x", "gone@x", "V15"),
            ("ghsas/all.json", "2024", "2024 ", "V2-V4"),
        ),
        (
            ("messages/2024.jsonl", '{"message_id":"two@x"', '{"message_id:"two@x"', "V5"),
            ("bodies/2024.jsonl", '"message_id":"one@x"', '"message_id":"xxx@x"', "V11"),
        ),
    )
    before = {path: (out / path).read_text() for path in ("messages/2024.jsonl", "bodies/2024.jsonl", "cves/2024.json", "ghsas/all.json")}
    for damages in rounds:
        for path, text in before.items():
            (out / path).write_text(text)
        for path, was, now, _ in damages:
            text = (out / path).read_text()
            assert was in text
            (out / path).write_text(text.replace(was, now))
        assert {expected for *_, expected in damages} <= violations(spark, out)


def test_changed_shards(spark):
    schema = "kind string, shard string, count long, sha256 string, bytes long"
    old = spark.createDataFrame([("m", "1", 1, "a", 1), ("m", "2", 1, "b", 1), ("m", "3", 1, "c", 1)], schema)
    new = spark.createDataFrame([("m", "1", 1, "a", 1), ("m", "2", 1, "x", 1), ("m", "4", 1, "d", 1)], schema)
    assert {(r["shard"], r["change"]) for r in shards.changed_shards(old, new).collect()} == {("2", "changed"), ("3", "gone"), ("4", "new")}


def test_logs(spark, tmp_path):
    (tmp_path / "log.tsv").write_text("t1\timport\t5\t4\t1\t1\tboom\nt2\tscrape\tr\t0\nt3\timport\t6\t6\t0\t0\tnone\n")
    assert archive.last_run(archive.run_log(spark, f"file://{tmp_path}/log.tsv"), "import").first()["fields"][0] == "t3"
    lines = spark.createDataFrame([("SCRAPE_WARN\tno-pre-block\tu\tx",), ("RESIDUAL\tX-Spam",), ("noise",)], "value string")
    assert sorted((r["kind"], r["category"]) for r in archive.warnings(lines).collect()) == [("RESIDUAL", "X-Spam"), ("SCRAPE_WARN", "no-pre-block")]
    (tmp_path / "box/cur").mkdir(parents=True)
    (tmp_path / "box/tmp").mkdir()
    (tmp_path / "box/cur/1").write_bytes(b"a")
    (tmp_path / "box/tmp/2").write_bytes(b"b")
    assert [bytes(r["raw"]) for r in archive.maildir(spark, f"file://{tmp_path}/box").select(F.col("raw")).collect()] == [b"a"]


def test_documents_are_spread_before_messages_are_made(spark):
    from lettermill.plans import catalog_index

    plan = catalog_index.made_log(spark, "/root/testdata/sf0.001", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange")  # printed from the top


def test_dates_of_received_headers_are_cleaned_once(spark):
    from lettermill.plans import index
    from lettermill.profile import Profile

    assert str(index._received_date(F.col("hs"), Profile(hop="hop"))).count("regexp_replace") < 10
