"""Scalars against plain Python and worked cases."""

import hashlib

from pyspark.sql import functions as F

from lettermill.functions import ids, mail, mime, text


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


def test_fold_and_normal_body(spark):
    assert one(spark, text.fold(F.col("c")), c="  a\t\n\x0b b  c ") == "a b c"
    body = "Hi user@example.org,\n>>From here\n >From there   x"
    assert one(spark, text.normal_body(F.col("c")), c=body) == "Hi user@, From here >From there x"


def test_bodies_differ_accepts_prefixes_and_masked_addresses(spark):
    differ = text.bodies_differ(F.sha1("a"), F.sha1("b"), F.col("a"), F.col("b"))
    assert one(spark, differ, a="mail x@y.org now", b="mail  x@.... now and a footer") is False
    assert one(spark, differ, a="one thing", b="another thing") is True
    assert one(spark, differ, a="same", b="same") is False


def test_truncate_at_line_or_character(spark):
    assert one(spark, text.truncate(F.col("c"), 10), c="abc\ndef\nghijkl") == "abc\ndef\n"
    assert one(spark, text.truncate(F.col("c"), 5), c="ééééé") == "éé"
    assert one(spark, text.truncate(F.col("c"), 14), c="abc\ndef\nghijkl") == "abc\ndef\nghijkl"
    whole = "x" * text.BODY_LIMIT
    assert one(spark, F.length(text.truncate(F.col("c"))), c=whole) == text.BODY_LIMIT


def test_json_string(spark):
    said = one(spark, text.json_string(F.col("c")), c='a"b\\c\n\t\x1f\x7f/é')
    assert said == '"a\\"b\\\\c\\n\\t\\u001f\x7f/é"'
    assert one(spark, text.json_string(F.lit(None).cast("string"))) == "null"


def test_pages(spark):
    page = '<html><PRE style="x">one <a href="/x">two</a> <b>three</b> &lt;x&gt;</PRE><li><a href="12"><li><a href="3"><li><a href="12">'
    assert one(spark, text.decode_entities(text.strip_tags(text.pre_block(F.col("c")))), c=page) == "one two three <x>"
    assert one(spark, text.index_links(F.col("c")), c=page) == [3, 12]
    assert one(spark, text.pre_block(F.col("c")), c="<p>none</p>") is None


def test_identifiers(spark):
    said = "éCVE-2024-1234 xCVE-2024-9999 cve-1066-123456_ CVE-2107-00001, CVE-2024-123 cve-2024-1234"
    assert one(spark, ids.cve_ids(F.col("c")), c=said) == ["CVE-2024-1234", "CVE-2107-00001"]
    advisory = "https://x/GHSA-2WHQ-6rcm-64m8/ GHSA-aaaa-2222-3333"
    assert one(spark, ids.ghsa_ids(F.col("c")), c=advisory) == ["GHSA-2whq-6rcm-64m8"]


def test_content_ids(spark):
    raw = b"Subject: x\n\nbody"
    expected = hashlib.sha1(b"blob %d\0" % len(raw) + raw).hexdigest()
    assert one(spark, ids.blob_id(F.col("c")), c=bytearray(raw)) == expected
    name = ids.synthetic_id("list", F.lit("d"), F.lit(None).cast("string"), F.lit("s"), F.lit("b"))
    assert one(spark, name) == hashlib.sha256(b"d\0\0s\0b").hexdigest()[:32] + "@synthetic.list"


HEAD = "Received: from mx.sub.org by box.sub.org; Mon, 1 Jan 2024 10:00:00 +0000\r\nX-Spam-Status: No\r\nX-Rspamd-Score: 1\r\nReceived: from a.org by mail.hop.net\r\n (8.1) with SMTP;\r\n Mon, 01 Jan 2024 09:00:00 -0500\r\nDKIM-Signature: z\r\nMessage-ID:\r\n <id1@a.org>\r\njunk line\r\nReferences: <r1@x> <r2@y>\r\nSubject: hello"


def test_headers(spark):
    hs = mail.headers(F.col("c"))
    assert one(spark, mail.message_id(hs), c=HEAD) == "id1@a.org"
    assert one(spark, mail.in_reply_to(hs), c=HEAD) == "r2@y"
    assert one(spark, mail.in_reply_to(hs), c=HEAD + "\nIn-Reply-To: <p@z> <q@z>") == "p@z"
    assert one(spark, mail.boundary(hs, r"hop\.net"), c=HEAD) == 3
    kept = one(spark, F.transform(mail.sanitized(hs, r"hop\.net"), lambda h: h["name"]), c=HEAD)
    assert kept == ["Received", "DKIM-Signature", "Message-ID", "References", "Subject"]
    assert one(spark, mail.residual(hs, r"hop\.net"), c=HEAD) == ["DKIM-Signature"]
    assert one(spark, F.size(mail.sanitized(hs, r"other\.net")), c=HEAD) == 7  # no boundary: only the anywhere set goes


def test_rotated_hosts(spark):
    assert one(spark, mail.plain_hosts(F.col("c")), c="<a@erqung.pbz> <b@groups.com> <c@host.zzz>") == "<a@redhat.com> <b@groups.com> <c@host.zzz>"


def test_dates(spark):
    assert one(spark, mail.mail_date(F.col("c")), c="Mon, 1 Jan 2024 10:00:00 -0500 (EST)") == 1704121200
    assert one(spark, mail.mail_date(F.col("c")), c="01 Jan 2024 10:00 GMT") == 1704103200
    assert one(spark, mail.mail_date(F.col("c")), c="yesterday") is None
    assert one(spark, mail.day_of_url(F.col("c")), c="https://x/list/2024/01/02/3") == 1704153600
    assert one(spark, mail.guarded_date(F.lit(300_000), F.lit(0))) == 0
    assert one(spark, ids.from_iso(F.col("c")), c="2024-01-01T00:00:00Z") == 1704067200
    assert one(spark, ids.from_iso(F.col("c")), c="2024-01-01 00:00:00") is None


def test_mime():
    raw = b"From: =?utf-8?q?J=C3=B6rg?= <x@y>\nSubject: =?iso-8859-1?q?caf=E9?=\n folded\nContent-Type: multipart/mixed; boundary=b\n\n--b\nContent-Disposition: attachment\nContent-Type: text/plain\n\nno\n--b\nContent-Type: text/plain; charset=iso-8859-1\nContent-Transfer-Encoding: quoted-printable\n\ncaf=E9\n--b--\n"
    assert mime.parse_one(raw) == ("Jörg <x@y>", "café folded", "café")
    sender, subject, body = mime.parse_one(b"Content-Type: text/html\n\n<p>one</p><p>two &amp; three</p>")
    assert (sender, subject, body) == (None, None, "one\n\ntwo & three")


def test_sanitizing_finds_the_boundary_once(spark):
    said = str(mail.sanitized(F.col("hs"), "hop"))
    assert said.count("split(") == 1 and said.count("filter(") < 10  # a lambda evaluates what it names for each header


def test_residual_headers_find_the_boundary_once(spark):
    assert str(mail.residual(F.col("hs"), "hop")).count("split(") == 1


def test_received_clauses_cut_words_once(spark):
    assert str(mail.trace_clause(F.col("c"), "by")).count("split(") == 1


def test_boundary_reads_each_received_header_once(spark):
    assert str(mail.boundary(F.col("hs"), "hop")).count("split(") == 1


def test_dates_are_cleaned_once(spark):
    assert str(mail.mail_date(F.col("c"))).count("regexp_replace") < 10
    for said, want in (("1 Jan 1970 00:00 EST", 18_000), ("Thu, 1 Jan 1970 01:00:01 +0100 (x)", 1), ("1 Jan 1970 00:00 pdt ", 25_200), ("31 Feb 1970 00:00 GMT", None), ("1 Jan 1970 00:00 ABC", None)):
        assert one(spark, mail.mail_date(F.col("c")), c=said) == want


def test_truncate_needs_no_python(spark):
    texts = ["ab\ncdefgh", "äöüßäöü", "a€€€€€€", "x😀😀😀", "\nabcdefghij", "abcdefgh", ""]
    for limit in range(4, 9):
        got = spark.createDataFrame([(x,) for x in texts], "c string").select("c", text.truncate(F.col("c"), limit).alias("t"))
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
        for c, t in got.collect():
            raw = c.encode()
            cut = raw[: raw.rfind(b"\n", 0, limit) + 1] or raw[:limit].decode(errors="ignore").encode()
            assert t.encode() == (raw if len(raw) <= limit else cut)
