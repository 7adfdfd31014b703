"""Temporal list joins: worked cases, and random lists against a plain loop."""

import random
from datetime import datetime, timedelta, timezone

from lettermill.llm import urlfilter

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
CAPTURE = "page_id long, url string, fetched_at timestamp, key string, best string"
CHANGE = "pattern string, action string, change string, at timestamp"


def day(n):
    return T0 + timedelta(days=n)


def run(stored, captures, changes):
    rows = urlfilter.judge(stored([(*c, "k", "b") for c in captures], CAPTURE), stored(changes, CHANGE)).collect()
    return {r["page_id"]: (r["verdict"], r["pattern"]) for r in rows}, rows


CHANGES = [
    ("bad.org", "block", "add", day(10)),
    ("bad.org", "block", "remove", day(20)),
    ("bad.org", "block", "add", day(30)),
    ("ok.bad.org", "allow", "add", day(0)),
    ("ok.bad.org/private/", "block", "add", day(0)),
    ("tie.org", "block", "add", day(0)),
    (None, "block", "add", day(0)),
    ("x.org", None, "add", day(0)),
    ("x.org", "block", "add", None),
]


def test_verdicts_follow_the_time_of_the_fetch(stored):
    captures = [
        (1, "http://bad.org/", day(9)),
        (2, "https://user@www.BAD.org:80/a?b", day(10)),
        (3, "http://bad.org", day(20)),
        (4, "http://bad.org/x", day(31)),
        (5, "http://a.ok.bad.org/private/1", day(31)),
        (6, "http://ok.bad.org/private/1", day(31)),
        (7, "http://ok.bad.org/privateer/1", day(31)),
        (8, "http://notbad.org/", day(15)),
        (9, None, day(15)),
        (10, "not a url", day(15)),
        (11, "http://bad.org/", None),
        (12, "http://x.org/", day(15)),
    ]
    got, rows = run(stored, [*captures, captures[1]], CHANGES)
    assert len(rows) == 13
    assert got == {
        1: ("none", None), 2: ("block", "bad.org"), 3: ("none", None), 4: ("block", "bad.org"), 5: ("allow", "ok.bad.org"), 6: ("block", "ok.bad.org/private/"),
        7: ("allow", "ok.bad.org"), 8: ("none", None), 9: ("none", None), 10: ("none", None), 11: ("none", None), 12: ("none", None),
    }


def test_random_lists(stored):
    rng = random.Random(1)
    names = ["a.org", "b.a.org", "c.b.a.org", "d.net"]
    patterns = names + [f"{n}/p/" for n in names] + ["b.a.org/p/q/"]
    changes = list({(rng.choice(patterns), rng.choice(["block", "allow"]), rng.choice(["add", "add", "remove"]), day(k)) for k in range(120)})
    captures = [(k, f"http://{rng.choice(names)}/{rng.choice(['', 'p', 'p/', 'p/q', 'p/q/r', 'z/p/'])}", day(rng.randrange(130))) for k in range(200)]
    got, _ = run(stored, captures, changes)

    def verdict(url, at):
        host, _, path = url[7:].partition("/")
        state = {}
        for pattern, action, change, when in sorted(changes, key=lambda c: c[3]):
            if when <= at:
                state[pattern] = action if change == "add" else None
        best = ("none", None, (-1, -1))
        for pattern, action in state.items():
            base, _, prefix = pattern.partition("/")
            segments = [s for s in path.split("/") if s]
            wanted = [s for s in prefix.split("/") if s]
            hit = (host == base and segments[: len(wanted)] == wanted) if wanted else (host == base or host.endswith("." + base))
            if action and hit and (len(wanted), base.count(".")) > best[2]:
                best = (action, pattern, (len(wanted), base.count(".")))
        return best[:2]

    assert got == {k: verdict(u, t) for k, u, t in captures}


def test_empty_tables(stored):
    assert run(stored, [], CHANGES)[1] == []
    assert run(stored, [(1, "http://bad.org", day(1))], [])[0] == {1: ("none", None)}


def test_long_histories_are_looked_up_by_stretches_of_time(stored, monkeypatch):
    monkeypatch.setattr(urlfilter, "MOST_ENTRIES", 2)
    test_random_lists(stored)
    test_verdicts_follow_the_time_of_the_fetch(stored)
    rng = random.Random(4)
    changes = [("a.org", "block" if k % 2 else "allow", "remove" if k % 3 == 2 else "add", T0 + timedelta(hours=k if k < 60 else 50 * k)) for k in range(90)]
    captures = [(k, "http://x.a.org/", T0 + timedelta(hours=rng.uniform(-20, 4700))) for k in range(200)] + [(900, "http://a.org/", changes[40][3]), (901, "http://a.org/", changes[-1][3])]
    got, _ = run(stored, captures, changes)
    for page, _, at in captures:
        state = next((c for c in reversed(changes) if c[3] <= at), None)
        assert got[page] == ((state[1], "a.org") if state and state[2] == "add" else ("none", None))
