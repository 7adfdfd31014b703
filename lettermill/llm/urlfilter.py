"""URL filters as a temporal list join.

A list is a log of dated changes: a pattern is added for blocking or allowing, or removed. Each pattern's
changes become validity intervals [from, until), and every capture is judged by the entries that were
active when it was fetched. A pattern is a domain ("example.org", which covers its subdomains) or a domain
and leading path segments ("example.org/a/b/"). Of the active matches the most specific decides: more path,
then more labels; at equal rank "allow" wins over "block".

As-of join: a capture is looked up under each key that a pattern can have (its domain suffixes, and path
prefixes as deep as the list's deepest). Each key has one row, its intervals in order, from which the one
that holds the fetch time is taken, so the join never multiplies rows by a pattern's history. A pattern with more than
`MOST_ENTRIES` intervals has a row for each of as many stretches of time as that asks for, with the intervals
that reach into it, and is looked up by key and stretch; so no look-up carries a long history.

Scale: only keys and times move, never pages. Hot keys are those of more than one in `HOT_SHARE` look-ups; at most
HOT_SHARE keys can be, so their rows of the list, of MOST_ENTRIES intervals at most, are broadcast, and all others
join by shuffle.

Defined results: a null or unparsable url has an empty host and no match, as has a null fetch time; changes
with a null pattern, action or date are ignored; of changes to a pattern at the same time a removal counts
last; an add to an active pattern changes its action; repeated captures are judged each by itself; empty
tables give no rows or no matches; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.operators.skew import join_unique
from lettermill.session import materialize

HOT_SHARE = 1000
MOST_ENTRIES = 16
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def intervals(changes: DataFrame) -> DataFrame:
    """pattern, action, since, until (null: still active) from (pattern, action, change, at)."""
    known = changes.filter("pattern is not null and action is not null and change is not null and at is not null")
    order = Window.partitionBy("pattern").orderBy("at", (F.col("change") == "remove").cast("int"), "action")
    spans = known.withColumn("until", F.lead("at").over(order)).filter("change = 'add' and (until is null or until > at)")
    return spans.select("pattern", "action", F.col("at").alias("since"), "until")


def depth_of(pattern: Column) -> Column:
    """Path segments in a pattern."""
    return F.greatest(F.size(F.split(pattern, "/")) - 2, F.lit(0))


def keys_of(host: Column, path: Column, deepest: int) -> Column:
    """Every pattern that could cover a url."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    if not deepest:
        return suffixes
    parts = F.slice(F.filter(F.split(path, "/", deepest + 2), lambda s: s != ""), 1, deepest)
    prefixes = F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))))
    return F.concat(suffixes, F.coalesce(prefixes, F.array().cast("array<string>")))


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """The operator: captures (page_id, url, fetched_at) with host, verdict, pattern and since."""
    spans = materialize(intervals(changes), "intervals")
    deepest = spans.agg(F.max(depth_of(F.col("pattern")))).first()[0] or 0
    labels = F.size(F.split(F.split_part("pattern", F.lit("/"), F.lit(1)), r"\."))
    entry = F.struct(depth_of(F.col("pattern")).alias("depth"), labels.alias("labels"), F.col("action"), "since", "until", "pattern")
    first, last = F.unix_seconds(F.min("since")), F.unix_seconds(F.max(F.greatest("since", F.coalesce("until", "since"))))
    counted = spans.groupBy(F.col("pattern").alias("key")).agg(F.ceil(F.count("*") / MOST_ENTRIES).alias("parts"), first.alias("first"), last.alias("last"))
    many = materialize(counted.filter("parts > 1").select("key", "parts", "first", ((F.col("last") - F.col("first")) / F.col("parts") + 1).alias("width")), "long-histories")
    listed = spans.withColumn("key", F.col("pattern")).withColumn("entry", entry)
    arrays = F.array_sort(F.collect_list("entry")).alias("entries")
    history = listed.join(many, "key", "left_anti").groupBy("key").agg(arrays)
    rows = captures.select(F.monotonically_increasing_id().alias("_row"), F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("fetched_at").alias("at"))
    asked = rows.select("_row", "page_id", "host", "at", F.explode(F.concat(F.array(F.lit(None).cast("string")), keys_of(F.col("host"), F.col("path"), deepest))).alias("key"))
    asked = materialize(asked, "look-ups")
    looked = asked.filter("key is not null and key <> '' and at is not null")
    total = looked.count()
    hot = looked.groupBy("key").count().filter(F.col("count") * HOT_SHARE > total).join(history, "key", "left").select("key", F.lit(True).alias("hot"), "entries")
    # At most HOT_SHARE rows: more keys cannot each have over one in HOT_SHARE of the look-ups.
    split = looked.join(F.broadcast(materialize(hot, "hot-keys")), "key", "left")
    from_hot = split.filter("hot and entries is not null").select("_row", "page_id", "host", "at", "entries")
    from_rest = split.filter("hot is null").drop("entries", "hot").join(history, "key").select("_row", "page_id", "host", "at", "entries")
    active = lambda e: (e["since"] <= F.col("at")) & (e["until"].isNull() | (F.col("at") < e["until"]))
    matched = from_hot.unionByName(from_rest)
    if not many.isEmpty():
        stretch = lambda t: F.greatest(F.lit(0), F.least(F.col("parts") - 1, F.floor((F.unix_seconds(t) - F.col("first")) / F.col("width")))).cast("long")
        slot = lambda k: F.concat("key", F.lit(" "), k.cast("string")).alias("slot")
        reach = F.sequence(stretch(F.col("since")), F.when(F.col("until").isNull(), F.col("parts") - 1).otherwise(stretch(F.col("until"))))
        long = listed.join(many, "key").select("key", "entry", F.explode(reach).alias("k")).select(slot(F.col("k")), "entry").groupBy("slot").agg(arrays)
        known = join_unique(looked, many, "key").select("_row", "page_id", "host", "at", slot(stretch(F.col("at"))))
        matched = matched.unionByName(join_unique(known, materialize(long, "stretches"), "slot").select("_row", "page_id", "host", "at", "entries"))
    found = matched.withColumn("entry", F.get(F.filter("entries", active), 0)).filter("entry is not null")
    rank = F.struct(F.col("entry.depth"), F.col("entry.labels"), (F.col("entry.action") == "allow").alias("allows"), F.col("entry.action"), F.col("entry.pattern"), F.col("entry.since"))
    every = asked.filter("key is null").select("_row", "page_id", "host", "at", F.lit(None).cast("struct<depth:int,labels:int,allows:boolean,action:string,pattern:string,since:timestamp>").alias("best"))
    best = found.select("_row", "page_id", "host", "at", rank.cast("struct<depth:int,labels:int,allows:boolean,action:string,pattern:string,since:timestamp>").alias("best"))
    decided = every.unionByName(best).groupBy("_row").agg(F.max("page_id").alias("page_id"), F.max("host").alias("host"), F.max("at").alias("fetched_at"), F.max("best").alias("best"))
    return decided.select("page_id", "host", "fetched_at", F.coalesce("best.action", F.lit("none")).alias("verdict"), F.col("best.pattern").alias("pattern"), F.col("best.since").alias("since"))


# ---- a dated list for tables that bring none ----


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time in 2024 that follows from page_id."""
    second = F.lit(1704067200) + F.pmod(F.col("page_id").cast("long") * 7919, F.lit(31622400))
    return pages.select("page_id", "url", F.timestamp_seconds(second).alias("fetched_at"))


def changes_by_rule(pages: DataFrame) -> DataFrame:
    """A change log that follows from the hosts: digits of their md5 choose patterns and dates.

    Of 16 hosts: 4 are blocked from a day on for 60 days, and again 120 days later; 2 have their parent
    domain blocked; 2 have their /en/ pages blocked; 2 are allowed for 200 days.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    digit = lambda a, n: F.conv(F.substring(F.md5(F.col("host").cast("binary")), a, n), 16, 10).cast("int")
    day = lambda n: F.timestamp_seconds(F.lit(1704067200) + (F.col("day") + n).cast("long") * 86400)
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    log = lambda pattern, action, *days: [F.struct(pattern.alias("pattern"), F.lit(action).alias("action"), F.lit("remove" if k % 2 else "add").alias("change"), day(n).alias("at")) for k, n in enumerate(days)]
    d, host = F.col("kind"), F.col("host")
    rule = (
        F.when(d < 4, F.array(*log(host, "block", 0, 60, 120)))
        .when(d < 6, F.array(*log(parent, "block", 0)))
        .when(d < 8, F.array(*log(F.concat(host, F.lit("/en/")), "block", 0)))
        .when(d < 10, F.array(*log(host, "allow", 0, 200)))
    )
    return hosts.withColumns({"kind": digit(1, 1), "day": digit(2, 2)}).select(F.explode(rule).alias("c")).select("c.*").distinct()
