"""Publishing: good builds replace the index, bad ones do not; logs of runs; rewriting a log; streams."""

import json

import pytest
from pyspark.sql import functions as F
from test_index import MESSAGES, PROFILE, inbox  # noqa: F401

from lettermill.plans import publish
from lettermill.sinks import logs
from lettermill.sources import archive
from lettermill.streaming import ingest


def test_publish_and_roll_back(spark, inbox, tmp_path, monkeypatch):  # noqa: F811
    stored = archive.stored_messages(spark, inbox)
    out, status = f"file://{tmp_path}/index", f"file://{tmp_path}/status.json"
    report = publish.publish(stored, out, PROFILE, status=status, run=(3, 1, "boom"))
    assert report.ok, report.first
    doc = json.loads((tmp_path / "status.json").read_text())
    assert doc["last_run"]["status"] == "ok" and doc["problems"] == ["1 message(s) failed ingest this run"] and doc["last_run"]["top_error"] == "boom"
    good = (tmp_path / "index/manifest.json").read_text()
    assert publish.summary(spark, out) | {"newest": 0, "bytes": 0} == {"stored": 5, "unique": 4, "duplicates": 1, "conflicts": 0, "fallback_dates": 1, "newest": 0, "cves": 2, "ghsas": 1, "bytes": 0}
    monkeypatch.setattr(publish, "check", lambda *a, **k: publish.Report(1, ["V6 seeded"]))
    report = publish.publish(stored, out, PROFILE, status=status)
    assert not report.ok and (tmp_path / "index/manifest.json").read_text() == good
    bad = json.loads((tmp_path / "status.json").read_text())
    assert bad["last_run"] | {"duration_s": 0} == {"status": "error", "duration_s": 0, "imported": 0, "failed": 0, "top_error": "V6 seeded"}
    assert bad["last_success_at"] == doc["last_success_at"] and bad["counts"] == doc["counts"]


def test_manifest_checks(spark, inbox, tmp_path):  # noqa: F811
    stored = archive.stored_messages(spark, inbox)
    out = f"file://{tmp_path}/index"
    publish.publish(stored, out, PROFILE)
    file = tmp_path / "index/manifest.json"
    manifest = json.loads(file.read_text())
    (tmp_path / "index/.manifest.json.crc").unlink()  # the file is edited below
    for change, said in (({"schema": 2}, "V1"), ({"total_cves": 9}, "V18"), ({"total_stored": 6}, "V19"), ({"ghsas": {}}, "V16"), ({"generated_at": "now"}, "V1")):
        file.write_text(json.dumps(manifest | change))
        assert any(x.startswith(said) for x in publish.check(spark, out, stored).first), change
    assert publish.document_violations(manifest) == []
    report = publish.check(spark, out, stored.limit(2))
    file.write_text(json.dumps(manifest))
    assert any("V20" in x for x in publish.check(spark, out, stored.limit(2)).first) and report.count


def test_rewrite_log(spark, inbox):  # noqa: F811
    stored = archive.stored_messages(spark, inbox)
    first = stored.orderBy("seq").first()
    rewritten, unmatched, counters = publish.rewrite_log(stored, r"hop\.net", [first["blob"], "nothing"])
    assert rewritten.count() == 4 and [r["blob"] for r in unmatched.collect()] == ["nothing"]
    row = counters.first()
    assert (row["changed"], row["unproven"]) == (0, 0)
    assert sorted(bytes(r["raw"]) for r in rewritten.collect()) == sorted(MESSAGES[1:-1])


def test_run_logs(spark, tmp_path):
    lines = spark.createDataFrame([("SCRAPE_WARN\tmsg-404\tu",), ("SCRAPE_WARN\tdiff-skip-known\tu",), ("SCRAPE_WARN\tdiff-skip-known\tv",), ("RESIDUAL\tX",), ("bad\tthing",), ("",)], "value string")
    report, n = logs.warning_report(lines)
    assert n == 3 and [tuple(r) for r in report.collect()] == [("diff-skip-known", 2), ("msg-404", 1)]
    assert logs.scrape_line("t", "scrape", "a..b", lines, 4) == "t\tscrape\ta..b\t3\tdiff-skip-known\t2\t2\t4"
    assert logs.scrape_line("t", "scrape", "a..b", lines.limit(0), 0).split("\t")[4:6] == ["none", "0"]
    line = logs.import_line("2024-01-02T00:00:00Z", "import", 5, 2, lines.filter("value not like 'SCRAPE%'"))
    assert line == "2024-01-02T00:00:00Z\timport\t5\t3\t2\t1\tbad thing"
    (tmp_path / "log.tsv").write_text(line + "\n")
    log = archive.run_log(spark, f"file://{tmp_path}/log.tsv")
    assert logs.run_counters(log, "import") == (3, 2, "bad thing") and logs.run_counters(log, "import", 1800000000) == (0, 0, None)
    (tmp_path / "set/aside").mkdir(parents=True)
    for name in ("a.eml", "b.html", "aside/c.html", "d.txt"):
        (tmp_path / "set" / name).write_text("x")
    assert {tuple(r) for r in logs.quarantined(spark, f"file://{tmp_path}/set").collect()} == {("eml", 1), ("html", 2)}


def test_ingest_takes_each_message_once(spark, tmp_path):
    schema = "mid string, seq long, ts timestamp"
    arriving, log = f"{tmp_path}/in", f"{tmp_path}/log"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(schema).parquet(arriving)
        ingest.ingest(stream, log, f"{tmp_path}/checkpoint", metrics=f"{tmp_path}/metrics").awaitTermination()
        return sorted((r["mid"], r["seq"]) for r in spark.read.parquet(log).collect())

    from datetime import datetime

    day = lambda n: datetime(2024, 1, n)
    assert run([("a", 1, day(1)), ("b", 2, day(1)), ("a", 3, day(1))]) in ([("a", 1), ("b", 2)], [("a", 3), ("b", 2)])
    again = run([("a", 4, day(9)), ("c", 5, day(9)), ("b", 6, day(2))])
    assert [m for m, _ in again] == ["a", "b", "c"]
    assert spark.read.parquet(f"{tmp_path}/metrics").agg(F.sum("imported")).first()[0] == 3


@pytest.mark.parametrize("reverse", [False, True])
def test_days(spark, reverse):
    d = lambda x: F.to_date(F.lit(x))
    left = spark.range(1).select(ingest.remaining_days(d("2024-01-01"), d("2024-01-04"), d("2024-01-03"), reverse).alias("x")).first()["x"]
    assert [x.day for x in left] == ([2, 1] if reverse else [4])
    assert len(spark.range(1).select(ingest.day_window(d("2024-01-04")).alias("x")).first()["x"]) == 2


def test_forged_dates_do_not_move_the_watermark(spark):
    rows = spark.sql("select timestamp'2030-01-01 00:00:00' as ts, timestamp'2024-01-01 00:00:00' as seen union all select timestamp'2024-01-02 00:00:00', timestamp'2024-01-01 00:00:00'")
    assert sorted(r["ts"].year for r in ingest.plausible(rows).collect()) == [2024, 2024]


def test_a_rename_that_fails_leaves_the_last_good_index(spark, inbox, tmp_path, monkeypatch):  # noqa: F811
    stored = archive.stored_messages(spark, inbox)
    out = f"file://{tmp_path}/index"
    assert publish.publish(stored, out, PROFILE).ok
    good = (tmp_path / "index/manifest.json").read_text()
    whole = publish._fs

    class Refusing:
        """A file system that refuses to rename what is staged, as a store does: by its result or an error."""

        def __init__(self, fs, error):
            self.fs, self.error = fs, error

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            if a.toString().endswith(".next"):
                if self.error:
                    raise OSError("refused")
                return False
            return self.fs.rename(a, b)

    for error in (False, True):
        with monkeypatch.context() as m:
            m.setattr(publish, "_fs", lambda spark, path, error=error: (Refusing(whole(spark, path)[0], error), whole(spark, path)[1]))
            with pytest.raises(OSError):
                publish.publish(stored, out, PROFILE)
        assert (tmp_path / "index/manifest.json").read_text() == good and not (tmp_path / "index.last").exists()
    assert publish.check(spark, out, stored).ok


def test_verify_command(spark, inbox, tmp_path):  # noqa: F811
    out = f"file://{tmp_path}/index"
    publish.publish(archive.stored_messages(spark, inbox), out, PROFILE)
    assert publish.main(["verify", out]) == 0 and publish.main([]) == 2 and publish.main(["verify", f"{out}-none"]) == 2
    shard = next((tmp_path / "index/messages").glob("*.jsonl"))
    for crc in (tmp_path / "index").rglob(".*.crc"):
        crc.unlink()
    shard.write_text(shard.read_text().replace("one@x", "oen@x"))
    assert publish.main(["verify", out]) == 1


def test_rewritten_log_is_swapped_in(spark, inbox, tmp_path):  # noqa: F811
    stored = archive.stored_messages(spark, inbox)
    rewritten, _, _ = publish.rewrite_log(stored, r"hop\.net")
    out = f"file://{tmp_path}/log"
    for _ in range(2):
        assert publish.replace_log(rewritten, out) == 5
        assert spark.read.parquet(out).count() == 5
    with pytest.raises(OSError):
        publish.replace_log(rewritten.withColumn("proven", F.lit(False)), out)
    assert spark.read.parquet(out).count() == 5


def test_file_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a/b.eml", bytearray(b"x")), ("c.html", bytearray(b"y"))], "name string, content binary")
    assert logs.set_aside(rows, f"file://{tmp_path}/aside") == 2 and (tmp_path / "aside/a_b.eml").read_bytes() == b"x"
    assert logs.set_aside(rows.limit(0), f"file://{tmp_path}/none") == 0
    for k in (1, 2):
        logs.append_line(spark, f"file://{tmp_path}/metrics", f"2024-01-0{k}T00:00:00Z\timport\t{k}\t{k}\t0\t0\tnone")
    assert logs.run_counters(archive.run_log(spark, f"file://{tmp_path}/metrics"), "import") == (2, 0, None)
    lines = spark.createDataFrame([("bad",), ("bad",), ("worse",)], "value string")
    assert logs.write_report(logs.error_report(lines), lines, f"file://{tmp_path}/errors", "errors") == 3
    text = [r["value"] for r in spark.read.text(f"file://{tmp_path}/errors").collect()]
    assert text[:4] == ["errors: 3", "       2 bad", "       1 worse", ""] and len(text) == 7
    assert logs.write_report(logs.error_report(lines.limit(0)), lines.limit(0), f"file://{tmp_path}/nothing", "errors") == 0 and not (tmp_path / "nothing").exists()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_kept_sets_parse_mail_once(spark):
    from lettermill.plans.catalog import queries

    assert "Python" not in _plan(queries()["j7_keep_set_of_parsed"](spark, "/root/testdata/sf0.001"))


def test_purge_sets_parse_mail_once(spark):
    from lettermill.plans.catalog import queries

    assert "Python" not in _plan(queries()["f8_scraped"](spark, "/root/testdata/sf0.001"))


def test_swapped_log_is_rewritten_once(spark, monkeypatch):
    from lettermill.plans.catalog import queries

    given = []
    monkeypatch.setattr(publish, "replace_log", lambda rewritten, out: (given.append(_plan(rewritten)), rewritten.write.mode("overwrite").parquet(out)))
    assert queries()["t8_log_swapped"](spark, "/root/testdata/sf0.001").first()["unexpected"] == 0
    assert len(given) == 2 and not any("regexp" in x for x in given)


def test_links_need_no_export(spark, monkeypatch):
    from lettermill.plans import catalog_index

    monkeypatch.setattr(catalog_index, "export", None)
    monkeypatch.setattr(catalog_index, "_PUBLISHED", {})
    assert catalog_index.x27_urls(spark, "/root/testdata/sf0.001").count() > 0


def test_rewriting_finds_each_boundary_once(spark):
    from lettermill.plans.catalog import queries

    plan = spark._jvm.PythonSQLUtils.explainString(queries()["k14_rewritten_log"](spark, "/root/testdata/sf0.001")._jdf.queryExecution(), "simple")
    assert 0 < plan.count("split(trim") < 3  # words of Received headers are cut once to strip, once to tell what stays
