"""Archives: exact round trips, and chains that false records do not break."""

import hashlib
import random

import numpy as np

from lettermill.llm import warc
from lettermill.session import shared_dir

PAGES = "page_id long, url string, html string, digest string, bytes long"


def expected(pages):
    """By row: payload bytes, digest, type, refers_to; of equal payloads the largest page_id answers."""
    groups = {}
    for k, (page, _, html) in enumerate(pages):
        data = (html or "").encode()
        if len(data) >= 1000:
            groups.setdefault(data, []).append((page is not None, page if page is not None else 0, -k))
    out = []
    for k, (page, url, html) in enumerate(pages):
        data = (html or "").encode()
        first = max(groups[data]) if data in groups else None
        again = first is not None and first != (page is not None, page if page is not None else 0, -k)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", (first[1] if first[0] else None) if again else None))
    return out


def trip(spark, stored, pages, split=700, file_bytes=5000):
    df = stored([(*p, "x", 1) for p in pages], PAGES)
    folder = f"{shared_dir(spark)}/warc-test-{random.random()}"
    manifest = warc.write_archives(df, folder, file_bytes)
    return manifest, warc.read_archives(manifest, split)


def test_round_trip_with_records_inside_payloads(spark, stored):
    rng = random.Random(1)
    fake = warc.record("99", "http://fake/", b"inner", 5, hashlib.sha1(b"inner").hexdigest(), None).decode()
    pages = [(k, f"http://h/{k}", "".join(rng.choice(["text ", "é", "\r\n\r\n", fake, "WARC/1.0\r\n"]) for _ in range(rng.randrange(40)))) for k in range(60)]
    pages += [(200, "http://h/a\r\nb", "z" * 1000), (201, None, "z" * 1000), (202, "u", "z" * 1000), (203, "u", "y" * 999), (204, "u", "y" * 999)]
    pages += [(205, "u", None), (206, "u", ""), (207, "u", "w" * 20000)]
    manifest, got = trip(spark, stored, pages)
    rows = sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect())
    assert rows == sorted(expected(pages))
    assert manifest.count() > 5 and {r["record_type"] for r in got.filter("page_id in (200, 201)").collect()} == {"revisit"}
    urls = {r["page_id"]: r["url"] for r in got.collect()}
    assert urls[200] == "http://h/a%0D%0Ab" and urls[201] is None


def test_null_and_repeated_ids(spark, stored):
    pages = [(None, "u", "q" * 1200), (None, "v", "q" * 1200), (5, "u", "p" * 1200), (5, "u", "p" * 1200), (None, "u", "s")]
    _, got = trip(spark, stored, pages)
    kinds = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], str(r["refers_to"])) for r in got.collect())
    assert kinds == [("5", 1200, "response", "None"), ("5", 1200, "revisit", "5"), ("None", 1, "response", "None"), ("None", 1200, "response", "None"), ("None", 1200, "revisit", "None")]


def test_empty_table(spark, stored):
    _, got = trip(spark, stored, [])
    assert got.collect() == []


def test_headers_of_any_length(spark, stored):
    long = "http://h/" + "u" * 200_000
    pages = [(0, long, "a"), (1, "v", "x" * 300), (2, long + "2", None), (3, "w", "WARC/1.0\r\na: " * 50), (4, long + "4", "end")]
    for split in (3000, 1 << 20):
        for order in (pages, pages[1:]):
            df = stored([(*p, "x", 1) for p in order], PAGES, 1)
            got = warc.read_archives(warc.write_archives(df, f"{shared_dir(spark)}/warc-test-{random.random()}"), split).collect()
            assert sorted((r["page_id"], r["url"], r["payload_bytes"]) for r in got) == [(p, u, len(h or "")) for p, u, h in order]


def test_candidates_are_what_parses():
    rng = random.Random(7)
    parts = [b"WARC/1.0\r\n", b"a: b\r\n", b"Content-Length: 7\r\n", b"Content-Length: x\r\n", b"\r\n", b"text", b"a:WARC/1.0\r\n", b"\r"]
    for _ in range(3000):
        data = b"".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        stop = rng.randrange(len(data) + 1)
        places = [k for k in range(stop) if data.startswith(warc.MAGIC, k)]
        expected = [(100 + k, 100 + x[1] + int(x[0][b"content-length"]) + 4) for k in places if (x := warc.parse_header(data, k))]
        offsets, successors = warc.candidate_links(data, 100, 100 + stop)
        assert list(zip(offsets.tolist(), successors.tolist(), strict=True)) == expected


def test_a_lost_record_is_an_error(spark, stored):
    import pytest
    from pyspark.sql import functions as F

    manifest, _ = trip(spark, stored, [(k, "u", "x" * 50) for k in range(5)])
    with pytest.raises(ValueError, match="differs from the manifest"):
        warc.read_archives(manifest.withColumn("records", F.col("records") + 1), 700)


def test_contraction_follows_chains_to_the_end_of_the_split():
    offsets = np.array([0, 10, 13, 20])
    successors = np.array([10, 20, 17, 35])
    assert warc.contracted(offsets, successors, 30).tolist() == [35, 35, -1, 35]


def test_a_broken_chain_is_an_error(spark, stored):
    import pytest

    from pathlib import Path

    for damage in (b"XARC/1.0\r\n", b"WARC/1.0\n\r"):
        manifest, _ = trip(spark, stored, [(k, "u", "x" * 50) for k in range(5)])
        path = Path(max(manifest.collect(), key=lambda r: r["records"])["path"].removeprefix("file://"))
        head, second = path.read_bytes().split(b"WARC/1.0\r\n", 2)[1:]
        path.write_bytes(b"WARC/1.0\r\n" + head + damage + second)
        for split in (700, 1 << 20):
            with pytest.raises(Exception, match="no record|differs"):
                warc.read_archives(manifest, split).collect()
