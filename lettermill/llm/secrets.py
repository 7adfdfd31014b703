"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans are the strict patterns. Weak parts (identifiers, opaque values, endpoints) mean nothing alone;
an interval join within scopes reports one only when parts that complement it start within `SCOPE` code
points: an identifier needs a secret, an opaque value needs an identifier, an endpoint needs both. Strict
spans complement weak ones too, and weak spans that overlap a strict one are dropped. Of weak spans that overlap
only the most telling kind counts, an identifier before an opaque value before an endpoint, so no part
complements itself: the value in `client_id: AbC...` is no secret, and a url with an opaque value in it no endpoint.

Positions: the pieces between matches (split) and the matches alternate, so prefix sums of their lengths, a
window over one document's matches, are code point positions. The interval join is on (row, bucket of SCOPE
code points): a side is first reduced to the least and largest start of each (row, bucket, role), which
decides exactly whether any part is near enough, so no pairs of parts are made.

Defined results: null text is empty; no matches give counts of 0, the hash of "" and empty spans; repeated
rows are scanned each by itself; null doc_id is kept; an empty table gives no rows; extra columns are
ignored. Everything stays within one document, so hot sources and copies are spread by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.session import materialize, rereadable

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the + form with 16+ characters: a run that is too short has no longer one inside
HEX = r"[0-9a-f]{32,}"
WEAK_ID = r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{4,11}|(?:ASIA|AIDA|AROA)[A-Z0-9]{4,})(?![A-Za-z0-9])|(?i:client_?id|access_?key_?id|user_?name)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z+/]*+[0-9])(?=[a-z0-9+/]*+[A-Z])[A-Za-z0-9+/]{20,}={0,2}(?![A-Za-z0-9+/_.=-])"
ENDPOINT = r"(?<![A-Za-z0-9])[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D\"'<>]+"

#: kind, pattern, cheap test for texts that cannot match, role, and the roles a weak span needs near it.
KINDS = (
    ("assign", ASSIGN, r"(?i)passw|secret|token|api_?key", "secret", ()),
    ("access", ACCESS, r"AKIA", "identifier", ()),
    ("hex", HEX, None, "secret", ()),
    ("weak_id", WEAK_ID, None, "identifier", ("secret",)),
    ("weak_secret", WEAK_SECRET, None, "secret", ("identifier",)),
    ("endpoint", ENDPOINT, r"://", "endpoint", ("identifier", "secret")),
)
BASE = 3
SCOPE = 512
LEAST_VALUE = 8
MASK = "[REDACTED]"


def _matches(text: Column, kind: int) -> Column:
    """Array of (kind, i, gap, len, value): what lies before each match, its length, its second group's."""
    _, pattern, hint, _, _ = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == 0 else found
    zipped = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("g"), value.alias("v"))
    rows = F.transform(zipped, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), F.length(x["v"]).alias("value")))
    return F.when(text.rlike(hint or pattern), rows)


def scan(docs: DataFrame) -> DataFrame:
    """_row, doc_id, kind, start, end for every reported span, and a row with null kind for every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    none = "array<struct<kind:int,i:int,gap:int,len:int,value:int>>"
    seat = F.array(F.struct(*[F.lit(v).cast("int").alias(n) for n, v in (("kind", None), ("i", -1), ("gap", 0), ("len", 0), ("value", 0))]))
    each = rows.select("_row", "doc_id", F.explode(F.concat(seat, *[F.coalesce(_matches(F.col("text"), k), F.array().cast(none)) for k in range(len(KINDS))])).alias("x"))
    each = each.select("_row", "doc_id", "x.*").filter("len is not null")
    upto = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.col("len")).over(upto)
    spans = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    spans = spans.filter(F.col("kind").isNull() | (F.col("kind") != 0) | (F.col("value") >= LEAST_VALUE)).select("_row", "doc_id", "kind", "start", "end")
    return _linked(materialize(spans, "spans"))


def _linked(spans: DataFrame) -> DataFrame:
    """All base spans and document rows; weak spans where their complements are in scope."""
    strict = F.col("kind") < BASE
    by_start = Window.partitionBy("_row").orderBy("start", "kind", "end")
    covered = F.max(F.when(strict, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0)) > F.col("start")
    meets = F.min(F.when(strict, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing)) < F.col("end")
    lesser = F.lit(False)
    for kind in (3, 4):  # a weak span of this kind that overlaps makes those of later kinds count for nothing
        own = F.col("kind") == kind
        ends_after = F.max(F.when(own, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0)) > F.col("start")
        starts_before = F.min(F.when(own, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing)) < F.col("end")
        lesser = lesser | ((F.col("kind") > kind) & (F.coalesce(ends_after, F.lit(False)) | F.coalesce(starts_before, F.lit(False))))
    marked = spans.withColumn("_overlaps", F.coalesce(covered, F.lit(False)) | F.coalesce(meets, F.lit(False)) | lesser)
    kept = marked.filter(F.col("kind").isNull() | strict | ~F.col("_overlaps")).drop("_overlaps")
    role = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    needs = F.element_at(F.array(*[F.array(*[F.lit(r) for r in k[4]]).cast("array<string>") for k in KINDS]), F.col("kind") + 1)
    bucket = F.floor(F.col("start") / SCOPE)
    parts = kept.filter("kind is not null").groupBy("_row", bucket.alias("bucket"), role.alias("role")).agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    weak = kept.filter(F.col("kind") >= BASE).withColumn("needs", needs)
    asked = weak.select("*", F.explode("needs").alias("role"), bucket.alias("home")).select("*", F.explode(F.array(F.col("home") - 1, F.col("home"), F.col("home") + 1)).alias("bucket"))
    near = (F.col("lo") <= F.col("start") + SCOPE) & (F.col("hi") >= F.col("start") - SCOPE)
    met = asked.join(parts, ["_row", "bucket", "role"]).filter(near).groupBy("_row", "doc_id", "kind", "start", "end", F.size("needs").alias("n")).agg(F.countDistinct("role").alias("met"))
    linked = met.filter("met = n").select("_row", "doc_id", "kind", "start", "end")
    return kept.filter(F.col("kind").isNull() | strict).unionByName(linked)


def find_secrets(docs: DataFrame) -> DataFrame:
    """The operator: one row for each document, with all spans in order."""
    name = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind") + 1)
    item = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end", F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string")).alias("said")))
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k][0]}")
    per = scan(docs).groupBy("_row").agg(F.max("doc_id").alias("doc_id"), *[count(k) for k in range(BASE)], F.array_sort(F.collect_list(item)).alias("found"))
    said = lambda a: F.array_join(F.transform(a, lambda x: x["said"]), ",")
    strict = F.filter("found", lambda x: x["kind"] < BASE)
    return per.select("_row", "doc_id", *[f"n_{KINDS[k][0]}" for k in range(BASE)], F.sha2(said(strict), 256).alias("base_sha256"), said(F.col("found")).alias("spans"), F.transform("found", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("ranges"))


def redact(docs: DataFrame) -> DataFrame:
    """Documents with every reported span replaced by a mask; n_chars follows the text."""
    docs = rereadable(docs)
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("doc"))
    hits = find_secrets(docs).filter(F.size("ranges") > 0).select(F.col("_row").alias("_hit"), "ranges")
    text = F.col("doc").getField("text")
    piece = lambda at, size: F.substring(text, at.cast("int") + 1, size)
    step = lambda acc, x: F.when(x["start"] >= acc["at"], F.struct(F.concat(acc["out"], piece(acc["at"], (x["start"] - acc["at"]).cast("int")), F.lit(MASK)).alias("out"), x["end"].alias("at"))).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], x["end"]).alias("at")))
    first = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    clean = F.aggregate("ranges", first, step, lambda acc: F.concat(acc["out"], piece(acc["at"], F.lit(2**31 - 1))))
    joined = numbered.join(hits, F.col("_row") == F.col("_hit"), "left").select("doc", F.when(F.col("_hit").isNotNull(), clean).alias("clean"))
    return with_text(joined, docs, F.col("clean"))


def with_text(joined: DataFrame, docs: DataFrame, changed: Column) -> DataFrame:
    """The columns of docs from the struct `doc`, with another text and n_chars where `changed` is not null."""
    new = {"text": changed, "n_chars": F.length(changed)}
    old = lambda c: F.col("doc").getField(c)
    return joined.select(*[F.coalesce(new[c].cast(t), old(c)).alias(c) if c in new else old(c).alias(c) for c, t in docs.dtypes])
