"""External induced suffix sorting with common-prefix values, for texts far larger than memory.

A suffix travels as a tuple: its first symbol, its place, the symbol before it, and its common prefix with the
tuple before it. Tuples stand in priority queues by (first symbol, arrival). A queue holds `memory` bytes; the
rest are sorted runs in files, which are merged as tuples are taken. The text and all arrays as long as it
are files too, mapped and paged by the system.

1. The suffixes that start where the text turns from falling to rising (LMS) are dealt by first symbol. An
   upward sweep over a queue induces the falling suffixes from them, a downward one the rising suffixes from
   those. Dealt LMS suffixes count as alike without end, so by the common prefixes carried equal strings from
   LMS place to LMS place are alike without end, and get one name.
2. If a name that repeats covers fewer than `depth` symbols of the text, the string of names is sorted by
   recursion; each name weighs as many symbols as it covers. A string of names that fits in `memory` is
   sorted there, by doubling, and its common prefixes are read from the text.
3. From the LMS suffixes in order, with their common prefixes, the same two sweeps induce all suffixes.

A tuple made from another one gets the weight of its symbol plus the least common prefix passed since the last
tuple of the same symbol was made (a range minimum within a batch, a stack of batch minima before it). Where
two neighbours were not made so (another first symbol, or falling against rising), a look at the text tells.
Common prefixes and the order go no deeper than `depth`. Long runs of one symbol are taken at once.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np

MEMORY_BYTES = 64 << 20
BLOCK = 1 << 16
MOST_FILES = 24
ALIKE = 255  # without end
NONE = (1 << 32) - 1
IN_MEMORY = 40  # bytes that sorting a name in memory takes
TUPLE = np.dtype([("key", "<u4"), ("at", "<u4"), ("before", "<u4"), ("common", "u1"), ("run", "u1")], align=True)


class Scratch:
    """Files of one sort, where Spark's own spills are too; they have no names, so they end with the task."""

    def __init__(self, memory: int = MEMORY_BYTES):
        self.memory = memory
        self.folder = next((d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)), None)

    def file(self):
        return tempfile.TemporaryFile(dir=self.folder)

    def array(self, n: int, kind: str) -> np.ndarray:
        """n zeros; in a file if they are many."""
        kind = np.dtype(kind)
        if n * kind.itemsize <= self.memory >> 3:
            return np.zeros(n, dtype=kind)
        with self.file() as f:
            f.truncate(n * kind.itemsize)
            return np.frombuffer(mmap.mmap(f.fileno(), n * kind.itemsize), dtype=kind)


class Log:
    """Tuples in order, appended to a file; read from the start or from the end."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.fresh, self.held, self.file, self.n = scratch, [], 0, None, 0

    def append(self, rows: np.ndarray) -> None:
        if len(rows):
            self.fresh.append(rows)
            self.held += rows.nbytes
            self.n += len(rows)
            if self.held > self.scratch.memory >> 3:
                self.flush()

    def flush(self) -> None:
        if self.fresh:
            self.file = self.file or self.scratch.file()
            self.file.seek(0, 2)
            for rows in self.fresh:
                self.file.write(np.ascontiguousarray(rows).data)
            self.fresh, self.held = [], 0

    def forward(self) -> Iterator[np.ndarray]:
        self.flush()
        for at in range(0, self.n, BLOCK):
            self.file.seek(at * TUPLE.itemsize)
            yield np.frombuffer(self.file.read(min(BLOCK, self.n - at) * TUPLE.itemsize), dtype=TUPLE).copy()

    def backward(self) -> Iterator[np.ndarray]:
        """Blocks from the last tuple on; `common` becomes that with the tuple before in this direction."""
        self.flush()
        following = 0
        for end in range(self.n, 0, -BLOCK):
            start = max(0, end - BLOCK)
            self.file.seek(start * TUPLE.itemsize)
            rows = np.frombuffer(self.file.read((end - start) * TUPLE.itemsize), dtype=TUPLE)[::-1].copy()
            first = rows["common"].copy()
            rows["common"][1:] = first[:-1]
            rows["common"][0] = following
            following = first[-1]
            yield rows


class Stream:
    """Tuples that come in blocks, sorted by key."""

    def __init__(self, blocks: Iterator[np.ndarray]):
        self.blocks, self.rows = blocks, np.empty(0, dtype=TUPLE)
        self.more(1)

    def more(self, n: int) -> None:
        while len(self.rows) < n:
            block = next(self.blocks, None)
            if block is None:
                return
            self.rows = np.concatenate([self.rows, block]) if len(self.rows) else block

    def first(self) -> int:
        return int(self.rows["key"][0]) if len(self.rows) else NONE

    def peek(self, limit: int, most: int) -> np.ndarray:
        """The first tuples with keys below limit, `most` of them at most."""
        self.more(most)
        rows = self.rows[:most]
        return rows[: np.searchsorted(rows["key"], limit)]

    def drop(self, n: int) -> None:
        self.rows = self.rows[n:]
        self.more(1)


def _by_key(rows: np.ndarray) -> np.ndarray:
    """Places of tuples by key, ties as they stand."""
    key = rows["key"]
    if not len(key) or key[0] == key[-1] and (key == key[0]).all():
        return np.arange(len(key))
    return np.argsort(key.astype(np.uint16) if int(key.max()) < 1 << 16 else key, kind="stable")


class Queue:
    """A priority queue by (key, arrival): runs in memory, and older ones in files once they exceed it."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.files: list[Stream] = []
        self.runs: list[np.ndarray] = []
        self.held = 0
        self.seen: tuple[list, np.ndarray, np.ndarray] | None = None

    def push(self, rows: np.ndarray, in_order: bool = False) -> None:
        """Add tuples in the order of their arrival (or by key already)."""
        if not len(rows):
            return
        self.runs.append(rows if in_order else rows[_by_key(rows)])
        self.held += rows.nbytes
        while len(self.runs) > 1 and len(self.runs[-2]) <= 2 * len(self.runs[-1]):
            both = np.concatenate(self.runs[-2:])
            self.runs[-2:] = [both[_by_key(both)]]
        if self.held > self.scratch.memory:
            every = np.concatenate(self.runs)
            self._spill(iter([every[_by_key(every)]]))
            self.runs, self.held = [], 0
            if len(self.files) > MOST_FILES:
                old = Queue(self.scratch)
                old.files, self.files = self.files, []
                self._spill(old.everything())

    def _spill(self, blocks: Iterator[np.ndarray]) -> None:
        file, n = self.scratch.file(), 0
        for rows in blocks:
            file.write(np.ascontiguousarray(rows).data)
            n += len(rows)
        size = max(1024, min(BLOCK, self.scratch.memory // (MOST_FILES * TUPLE.itemsize)))

        def read() -> Iterator[np.ndarray]:
            for at in range(0, n, size):
                file.seek(at * TUPLE.itemsize)
                yield np.frombuffer(file.read(min(size, n - at) * TUPLE.itemsize), dtype=TUPLE)

        self.files.append(Stream(read()))

    def everything(self) -> Iterator[np.ndarray]:
        while len(rows := self.peek(NONE, BLOCK)):
            yield rows
            self.drop(len(rows))

    def first(self) -> int:
        return min([s.first() for s in self.files] + [int(r["key"][0]) for r in self.runs], default=NONE)

    def peek(self, limit: int, most: int) -> np.ndarray:
        """The first tuples by (key, arrival) with keys below limit, `most` of them at most."""
        parts = [s.peek(limit, most) for s in self.files]
        for rows in self.runs:
            head = rows[:most]
            parts.append(head[: np.searchsorted(head["key"], limit)])
        some = [k for k, p in enumerate(parts) if len(p)]
        if len(some) == 1:
            rows = parts[some[0]]
            self.seen = parts, np.full(len(rows), some[0]), rows
            return rows
        every = np.concatenate(parts) if parts else np.empty(0, dtype=TUPLE)
        order = _by_key(every)[:most]
        source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])[order]
        self.seen = parts, source, every[order]
        return self.seen[2]

    def drop(self, n: int) -> None:
        """The first n tuples that the last peek showed are done with."""
        parts, source, _ = self.seen
        counts = np.bincount(source[:n], minlength=len(parts)).tolist()
        for stream, gone in zip(self.files, counts, strict=False):
            if gone:
                stream.drop(gone)
        at = len(self.files)
        self.runs = [rows[gone:] for rows, gone in zip(self.runs, counts[at:], strict=True) if len(rows) > gone]
        self.held = sum(r.nbytes for r in self.runs)
        self.files = [s for s in self.files if len(s.rows)]


class Minima:
    """Least value of any range of a batch."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of places low to high, both included."""
        out = np.empty(len(low), dtype=np.uint8)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            own = level == k
            values = self.levels[k]
            out[own] = np.minimum(values[low[own]], values[high[own] - (1 << k) + 1])
        return out


class Text:
    """Symbols at one level of the recursion, where each starts in the text below all, and what it weighs there."""

    def __init__(self, symbols: np.ndarray, sigma: int, base: np.ndarray, places: np.ndarray | None, weights: np.ndarray | None, depth: int):
        self.symbols, self.sigma, self.n = symbols, sigma, len(symbols)
        self.base, self.places, self.weights, self.depth = base, places, weights, depth
        size = base.itemsize
        self.words = np.ndarray((max(0, len(base) - 8 // size + 1),), dtype="<u8", buffer=base, strides=(size,))
        self.runs = self._long_runs()

    def weight(self, symbols: np.ndarray) -> np.ndarray:
        return np.ones(len(symbols), dtype=np.uint8) if self.weights is None else self.weights[symbols]

    def _long_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of one symbol that weigh `depth` or more, longest possible starts first by place."""
        starts, ends, held, symbol = [], [], 0, -1
        for at in range(0, self.n, BLOCK):
            part = np.asarray(self.symbols[at : at + BLOCK])
            turn = np.flatnonzero(part[1:] != part[:-1]) + 1
            first = np.concatenate([[0], turn]) + at
            last = np.concatenate([turn, [len(part)]]) + at
            if symbol == int(part[0]):
                first[0] = held
            held, symbol = int(first[-1]), int(part[-1])
            long = (last - first) * self.weight(np.asarray(self.symbols[first])).astype(np.int64) >= self.depth
            starts.append(first[long])
            ends.append(last[long])
        if not starts:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        starts, ends = np.concatenate(starts), np.concatenate(ends)
        keep = np.append(starts[1:] != starts[:-1], True) if len(starts) else np.empty(0, dtype=bool)  # a run over blocks ends in the last
        return starts[keep], ends[keep]

    def before(self, at: np.ndarray) -> np.ndarray:
        """The symbol before each place; NONE before the first."""
        return np.where(at > 0, self.symbols[np.maximum(at, 1) - 1].astype(np.uint32), np.uint32(NONE))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of pairs of suffixes, from the text; no more than depth."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        if self.places is not None:
            a, b = self.places[a].astype(np.int64), self.places[b].astype(np.int64)
        out = np.full(len(a), self.depth, dtype=np.uint8)
        per, live = 8 // self.base.itemsize, np.arange(len(a))
        for k in range(0, self.depth, per):
            x = self.words[a[live] + k] ^ self.words[b[live] + k]
            odd = np.flatnonzero(x)
            if len(odd):
                y = x[odd]
                bit = np.log2((y & (~y + np.uint64(1))).astype(np.float64)).astype(np.int64)
                out[live[odd]] = np.minimum(self.depth, k + bit // (8 * self.base.itemsize))
                live = live[x == 0]
                if not len(live):
                    break
        return np.minimum(out, len(self.base) - self.depth - 8 - np.maximum(a, b)).astype(np.uint8)  # what follows the text is no match

    def lms(self) -> Iterator[np.ndarray]:
        """Places of LMS suffixes, in blocks from the end of the text."""
        after, rises = -1, False  # symbol after the block, and whether the suffix there rises
        for end in range(self.n, 0, -BLOCK):
            start = max(0, end - BLOCK)
            low = max(0, start - 1)
            part = np.asarray(self.symbols[low:end]).astype(np.int64)
            following = np.append(part[1:], after)
            turn = np.flatnonzero(part != following)
            up = np.full(len(part), rises)
            if len(turn):
                value = part[turn] < following[turn]
                up[: turn[-1] + 1] = np.repeat(value, np.diff(turn, prepend=-1))
            own = up[1:] & ~up[:-1] & (part[1:] != part[:-1])
            yield (np.flatnonzero(own) + low + 1)[::-1]
            after, rises = int(part[start - low]), bool(up[start - low])


class Sweep:
    """One pass over suffixes by key (the first symbol, or from the last one down), inducing those before them."""

    def __init__(self, scratch: Scratch, text: Text, down: bool, rough: bool):
        self.text, self.down, self.rough, self.queue = text, down, rough, Queue(scratch)
        self.batch = 0
        self.last = scratch.array(text.sigma, "<u4")  # batch + 1 in which a symbol was last put in line
        self.tail = scratch.array(text.sigma, "u1")  # least common prefix from then to the end of that batch
        self.stack: list[tuple[int, int]] = []  # batch, least common prefix from that batch on to the next entry
        self.passed: tuple[int, int, bool] | None = None  # key, place, from the queue: the last suffix

    def key(self, symbol):
        return self.text.sigma - 1 - symbol if self.down else symbol

    def start(self) -> None:
        """The last suffix is falling: what follows it is smaller than any symbol."""
        n = self.text.n
        row = np.zeros(1, dtype=TUPLE)
        row["key"], row["at"], row["before"], row["run"] = self.text.symbols[n - 1], n - 1, self.text.before(np.array([n - 1])), 1
        self.queue.push(row)
        symbol = int(self.text.symbols[n - 1])
        self.last[symbol], self.tail[symbol] = 1, 0
        self.batch = 1
        self.stack = [(0, 0)]

    def run(self, seeds, put: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> None:
        """put(tuples, common prefixes, from the queue) gets every suffix, in order."""
        span = 1
        while True:
            c = min(self.queue.first(), seeds.first())
            if c == NONE:
                return
            limit = min(NONE, c + span)
            mine, given = self.queue.peek(limit, BLOCK), seeds.peek(limit, BLOCK)
            if span > 1 and (len(mine) == BLOCK or len(given) == BLOCK):
                span = 1
                continue
            if span > 1:
                made = [k[on] for rows, strict in ((mine, False), (given, True)) for k, on in [self._induced(rows, strict)]]
                least = min((int(m.min()) for m in made if len(m)), default=NONE)
                if least <= c:
                    span = 1
                    continue
                if least < limit:
                    mine, given = (rows[: np.searchsorted(rows["key"], least)] for rows in (mine, given))
                    span = max(1, span // 2)
                else:
                    span *= 2
            elif len(mine):  # one key: first what stands in line, also what it puts in line itself
                given = given[:0]
            else:
                span = 2 if len(given) < BLOCK // 4 else 1
            self.queue.drop(len(mine))
            seeds.drop(len(given))
            rows = np.concatenate([mine, given])
            queued = np.arange(len(rows)) < len(mine)
            if len(mine) and len(given):
                order = _by_key(rows)
                rows, queued = rows[order], queued[order]
            rest = self._run_on(rows, queued) if len(mine) else None
            self._pass(rows, queued, put, rest is not None)
            if rest is not None:
                self._finish_runs(rest, rows[0]["key"], put)
            elif span == 1 and len(mine) < BLOCK // 4:
                span = 2

    def _induced(self, rows: np.ndarray, strict: bool) -> tuple[np.ndarray, np.ndarray]:
        """Key of the symbol before each suffix, and whether this pass induces the suffix that starts there."""
        before = rows["before"]
        key = np.where(before == NONE, 0, self.key(before.astype(np.int64)))
        return key, (before != NONE) & ((key > rows["key"]) if strict else (key >= rows["key"]))

    def _pass(self, rows: np.ndarray, queued: np.ndarray, put, closed: bool) -> None:
        """Tell common prefixes, hand the batch out, and put what it induces in line. closed: no suffix of the same symbol is."""
        if not len(rows):
            return
        common = rows["common"].copy()
        key = rows["key"]
        seam = np.append(True, (key[1:] != key[:-1]) | (queued[1:] != queued[:-1]))
        if self.passed is None:
            common[0], seam[0] = 0, False
        else:
            seam[0] = self.passed[0] != key[0] or self.passed[2] != queued[0]
        at = np.flatnonzero(seam)
        if self.rough:
            common[at] = 0  # alike or not is all that is asked
        elif len(at):
            left = np.where(at > 0, rows["at"][at - 1], 0 if self.passed is None else self.passed[1])
            common[at] = self.text.common(left, rows["at"][at])
        self.passed = int(key[-1]), int(rows["at"][-1]), bool(queued[-1])
        put(rows, common, queued)
        new_key, made = self._induced(rows, True)
        made |= queued & (new_key == key) & (rows["before"] != NONE) & (not closed)
        source = np.flatnonzero(made)
        if len(source):
            fresh = np.zeros(len(source), dtype=TUPLE)
            fresh["key"], fresh["at"] = new_key[source], rows["at"][source] - 1
            own = fresh["key"] == key[source]
            fresh["run"] = np.where(own, np.minimum(rows["run"][source], 254) + 1, 1)
            order = _by_key(fresh)
            fresh, source = fresh[order], source[order]
            fresh["before"] = self.text.before(fresh["at"])
            fresh["common"] = self._inherited(fresh, source, common)
            self.queue.push(fresh, in_order=True)
        least = int(common.min())
        while self.stack and self.stack[-1][1] >= least:
            self.stack.pop()
        self.stack.append((self.batch, least))
        self.batch += 1

    def _inherited(self, fresh: np.ndarray, source: np.ndarray, common: np.ndarray) -> np.ndarray:
        symbol = self.key(fresh["key"].astype(np.int64))
        minima = Minima(common)
        head = np.append(True, symbol[1:] != symbol[:-1])
        low = np.where(head, 0, np.append(0, source[:-1] + 1))
        least = minima.of(low, source)
        heads, own = np.flatnonzero(head), symbol[head]
        known = self.last[own].astype(np.int64)
        batches = np.array([b for b, _ in self.stack], dtype=np.int64)
        values = np.array([v for _, v in self.stack] + [ALIKE], dtype=np.uint8)
        between = values[np.searchsorted(batches, known - 1, side="right")]
        earlier = np.minimum(self.tail[own], between)
        least[heads] = np.where(known > 0, np.minimum(least[heads], earlier), 0)
        ends = np.append(heads[1:], len(symbol)) - 1
        last = source[ends]
        self.last[own] = self.batch + 1
        tail = np.full(len(own), ALIKE, dtype=np.uint8)
        inside = last + 1 < len(common)
        tail[inside] = minima.of(last[inside] + 1, np.full(int(inside.sum()), len(common) - 1))
        self.tail[own] = tail
        total = least.astype(np.int64) + self.text.weight(symbol)
        return np.where(least == ALIKE, ALIKE, np.minimum(total, self.text.depth)).astype(np.uint8)

    def _run_on(self, rows: np.ndarray, queued: np.ndarray) -> np.ndarray | None:
        """Places in long runs of a symbol (a batch of one key) whose beginning weighs `depth`: the run's other places go at once."""
        if not len(self.text.runs[0]) or rows["key"][0] != rows["key"][-1]:
            return None
        weight = int(self.text.weight(self.key(rows["key"][:1].astype(np.int64)))[0])
        deep = queued & (rows["run"].astype(np.int64) * weight >= self.text.depth) & (rows["before"] == self.key(int(rows["key"][0])))
        return rows["at"][deep].astype(np.int64) if deep.any() and not (queued & ~deep & (rows["before"] == self.key(int(rows["key"][0])))).any() else None

    def _finish_runs(self, at: np.ndarray, key: int, put) -> None:
        """All places before `at` in their runs, as a batch like any other; only a run's first place induces more."""
        starts = self.text.runs[0][np.searchsorted(self.text.runs[0], at, side="right") - 1]
        sizes = at - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        for low in range(0, total, BLOCK):
            turn = np.arange(low, min(low + BLOCK, total))
            of = np.searchsorted(ends, turn, side="right")
            place = at[of] - 1 - (turn - (ends[of] - sizes[of]))
            rows = _tuples(key, place, NONE, self.text.depth)
            first = np.flatnonzero(place == starts[of])
            rows["before"][first] = self.text.before(place[first])
            self._pass(rows, np.ones(len(rows), dtype=bool), put, True)


def _tuples(key, at, before, common) -> np.ndarray:
    rows = np.zeros(len(at), dtype=TUPLE)
    rows["key"], rows["at"], rows["before"], rows["common"], rows["run"] = key, at, before, common, 1
    return rows


def _induce(scratch: Scratch, text: Text, seeds, put, rough: bool = False) -> None:
    """Both sweeps; put gets all suffixes from the last one down, with common prefixes with the one before."""
    falling = Log(scratch)
    up = Sweep(scratch, text, False, rough)
    up.start()
    up.run(seeds, lambda rows, common, queued: falling.append(rows[queued]))
    down = Sweep(scratch, text, True, rough)

    def turned() -> Iterator[np.ndarray]:
        for rows in falling.backward():
            rows["key"] = text.sigma - 1 - rows["key"]
            yield rows

    down.run(Stream(turned()), put)


def _sorted_lms(scratch: Scratch, text: Text) -> Log:
    """LMS suffixes from the last one down, with common prefixes (steps 1 and 2)."""
    dealt, lms = Queue(scratch), scratch.array(text.n // 2 + 1, "<u4")
    end = len(lms)
    for places in text.lms():
        if len(places):
            lms[end - len(places) : end] = places[::-1]
            end -= len(places)
            dealt.push(_tuples(np.asarray(text.symbols[places]), places, text.before(places), ALIKE))
    lms = lms[end:]
    n_lms = len(lms)
    if n_lms < 2:
        found = Log(scratch)
        found.append(_tuples(0, lms, 0, 0))
        return found
    names, name_of, rough = -1, scratch.array(text.n, "<u4"), Log(scratch)
    least = ALIKE  # of the common prefixes since the last LMS suffix
    place = lambda at: at.astype(np.int64) if text.places is None else text.places[at].astype(np.int64)

    def name(rows: np.ndarray, common: np.ndarray, queued: np.ndarray) -> None:
        nonlocal names, least
        symbol = text.sigma - 1 - rows["key"].astype(np.int64)
        own = np.flatnonzero(queued & (rows["before"] != NONE) & (rows["before"] > symbol))
        if not len(own):
            least = min(least, int(common.min()))
            return
        mins = np.minimum.reduceat(common[: own[-1] + 1], np.append(0, own[:-1] + 1))
        mins[0] = min(mins[0], least)
        least = int(common[own[-1] + 1 :].min()) if own[-1] + 1 < len(common) else ALIKE
        if names < 0:
            mins[0] = 0
        turn = np.cumsum(mins < text.depth) + names
        names = int(turn[-1])
        at = rows["at"][own]
        name_of[at] = turn
        rough.append(_tuples(turn, at, 0, mins))

    _induce(scratch, text, dealt, name, rough=True)
    total = names + 1
    weights = scratch.array(total, "u1")
    reduced, places = scratch.array(n_lms, "<u4"), scratch.array(n_lms, "<u4")
    stop = len(text.base) - text.depth - 8
    for at in range(0, n_lms, BLOCK):
        own = lms[at : at + BLOCK]
        reduced[at : at + BLOCK] = total - 1 - name_of[own]
        places[at : at + BLOCK] = place(own)
    for at in range(0, n_lms, BLOCK):
        own = places[at : at + BLOCK + 1].astype(np.int64)
        own = np.append(own, stop) if at + BLOCK >= n_lms else own
        weights[reduced[at : at + BLOCK]] = np.minimum(np.diff(own), text.depth)
    again = any(((rows["common"] == ALIKE) & (weights[total - 1 - rows["key"]] < text.depth)).any() for rows in rough.backward())
    del name_of
    found = Log(scratch)
    if not again:
        before = None
        for rows in rough.forward():
            left = np.append(rows["at"][:1] if before is None else before, rows["at"][:-1])
            rows["common"] = text.common(left, rows["at"])
            before = rows["at"][-1:]
            found.append(rows)
        return found
    deeper = Text(reduced, total, text.base, places, weights, text.depth)
    if n_lms * IN_MEMORY <= scratch.memory:
        order = _in_memory(reduced, text.depth)[::-1]
        for at in range(0, n_lms, BLOCK):
            own = order[at : at + BLOCK]
            found.append(_tuples(0, lms[own], 0, deeper.common(order[max(0, at - 1) : max(0, at - 1) + len(own)], own) if at else np.append(0, deeper.common(own[:-1], own[1:]))))
        return found
    _induce(scratch, deeper, _seeds(deeper, _sorted_lms(scratch, deeper)), lambda rows, common, queued: found.append(_tuples(0, lms[rows["at"]], 0, common)))
    return found


def _in_memory(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a string of names in the order of their first `depth` names; only what is still tied is sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    value = names[order]
    rank = np.empty(n, dtype=np.int64)  # place in the order of the first suffix of the same rank
    heads = np.append(True, value[1:] != value[:-1])
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    reach = 1
    tied = np.flatnonzero(~(heads & np.append(heads[1:], True)))
    while len(tied) and reach < depth:
        own = order[tied]
        first = rank[own]
        following = np.where(own + reach < n, rank[np.minimum(own + reach, n - 1)] + 1, 0)
        turn = np.argsort(first * (n + 1) + following, kind="stable")
        own, first, following = own[turn], first[turn], following[turn]
        order[tied] = own
        heads = np.append(True, (first[1:] != first[:-1]) | (following[1:] != following[:-1]))
        rank[own] = np.maximum.accumulate(np.where(heads, tied, 0))
        tied = tied[~(heads & np.append(heads[1:], True))]
        reach *= 2
    return order


def _seeds(text: Text, found: Log) -> Stream:
    """LMS suffixes in order as tuples."""

    def read() -> Iterator[np.ndarray]:
        for rows in found.backward():
            yield _tuples(np.asarray(text.symbols[rows["at"]]), rows["at"], text.before(rows["at"]), np.minimum(rows["common"], text.depth))

    return Stream(read())


def suffixes(symbols: np.ndarray, depth: int, put: Callable[[np.ndarray, np.ndarray], None], memory: int = MEMORY_BYTES) -> None:
    """put(places, common prefixes) gets all suffixes in blocks, from the last one down, by their first `depth` symbols.

    symbols: 8 or 16 bits each, fewer than 2^32. A common prefix is that with the suffix put before.
    """
    n = len(symbols)
    if not n:
        return
    if depth >= ALIKE or n >= NONE:
        raise ValueError("too deep or too long")
    scratch = Scratch(memory)
    base = scratch.array(n + depth + 8, symbols.dtype.str)
    base[:n] = symbols
    text = Text(base[:n], int(symbols.max()) + 1, base, None, None, depth)
    _induce(scratch, text, _seeds(text, _sorted_lms(scratch, text)), lambda rows, common, queued: put(rows["at"], common))
