"""External induced sorting of the suffixes of many short segments, with common prefixes.

The sorted suffixes at S* positions (left-most S type) induce all others: a pass
in rising order induces the L suffixes, one in falling order the S suffixes.  Both
passes take suffixes from a priority queue keyed by first symbol, whose tuples
are (position, length of the prefix in common with the suffix queued before it);
a suffix that leaves the queue queues the one that starts a symbol earlier, whose
common prefix is one longer than the least on the way since the last entry under that symbol.
Tuples of a symbol leave in the order they came, so the queue is a first-in
first-out list for each symbol, and whole runs are moved at once as arrays.  Lists
that are far from their turn go to a scratch file when the queue holds more than
`memory` bytes, and so do the L suffixes that wait for the second pass.  The result is
given out symbol by symbol as the second pass gets there, so of a shard
only the text, its types and the S* positions stay in memory.

The S* suffixes are sorted by the same passes over the S* substrings, which name
them, and by recursion on the string of names.  There symbols are many and lists short,
so the queue's key is a range of symbols, and the suffixes of a range that induce each
other are put in order together.  What the recursion leaves, `base` names or fewer, is
sorted by doubling.  Segments end in separators, which are below every symbol and
differ from each other, so nothing is compared beyond a segment.
"""

from __future__ import annotations

import os
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np

#: Common prefixes are counted up to this length.
CAP = 120
#: Names that are sorted in memory; more take another recursion.
BASE = 1 << 16
#: Bytes of tuples that a queue holds in memory.
MEMORY = 1 << 20
#: Symbols that have lists of their own, and suffixes of a range where there are more.
SYMBOLS, RANGE = 1 << 10, 1 << 16
#: How often queues went to disk and names were sorted by recursion in this process.
COUNTS: Counter[str] = Counter()


class SymbolQueue:
    """First-in first-out lists of (position, common prefix) by symbol, partly on disk."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held, self.lists, self.spilled = memory, 0, {}, {}
        self.file, self.end = None, 0

    def push(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        self.lists.setdefault(symbol, []).append((positions, common))
        self.held += positions.nbytes + common.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        """Write the longest lists until half of the memory is free; the order within a list is kept by its runs on disk."""
        if self.file is None:  # where Spark itself spills; the file has no name and goes with the task
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            self.file = tempfile.TemporaryFile(dir=folder if folder and os.path.isdir(folder) else None)
        COUNTS["spills"] += 1
        for symbol in sorted(self.lists, key=lambda s: -sum(len(p) for p, _ in self.lists[s])):
            positions = np.concatenate([p for p, _ in self.lists[symbol]])
            common = np.concatenate([c for _, c in self.lists[symbol]])
            del self.lists[symbol]
            self.file.seek(self.end)
            self.file.write(positions.tobytes())
            self.file.write(common.tobytes())
            self.spilled.setdefault(symbol, []).append((self.end, len(positions), len(common)))
            self.end += positions.nbytes + common.nbytes
            self.held -= positions.nbytes + common.nbytes
            if self.held <= self.memory // 2:
                break

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for at, n, k in self.spilled.pop(symbol, ()):
            self.file.seek(at)
            parts.append((np.frombuffer(self.file.read(4 * n), dtype=np.int32), np.frombuffer(self.file.read(k), dtype=np.uint8)))
        here = self.lists.pop(symbol, ())
        self.held -= sum(p.nbytes + c.nbytes for p, c in here)
        parts += here
        if not parts:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.uint8)
        return (parts[0][0], parts[0][1]) if len(parts) == 1 else (np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo..hi], both ends included, for each pair."""
    width = hi - lo + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    out = np.empty(len(lo), dtype=values.dtype)
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
    return out


class _Text:
    #: Symbols whose types are found at once.
    STEP = 1 << 18

    def __init__(self, symbols: np.ndarray):
        """symbols: 0 for a separator, the last symbol being one."""
        if len(symbols) >= 1 << 31:
            raise ValueError("a shard must have fewer than 2 ** 31 symbols")
        n = len(symbols)
        self.s, self.n = symbols, n
        self.small = np.ones(n, dtype=bool)  # S type
        after = True
        for hi in range(n - 1, 0, -self.STEP):
            lo = max(0, hi - self.STEP)
            now, later = symbols[lo:hi], symbols[lo + 1 : hi + 1]
            told = (now != later) | (now == 0)
            kind = (now < later) | (now == 0)
            # within a run the type is that of its end, which may lie in the part before
            end = np.where(told, np.arange(hi - lo, dtype=np.int32), np.int32(hi - lo))
            end = np.minimum.accumulate(end[::-1])[::-1]
            self.small[lo:hi] = np.append(kind, after)[end]
            after = self.small[lo]
        self.star = self.small.copy()
        self.star[0] = False
        self.star[1:] &= ~self.small[:-1]

    def run(self, at: int) -> int:
        """Equal symbols from a place, up to CAP."""
        part = self.s[at : at + CAP]
        return int(np.argmin(np.append(part == part[0], False)))

    def joined(self, a: int, b: int) -> int:
        """What an L suffix and an S suffix of one symbol have in common."""
        return min(self.run(a), self.run(b))


def _induce(t: _Text, stars: np.ndarray, common: np.ndarray | None, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but separators, symbol by symbol from the last: those of a symbol in order, with common prefixes if those of the sorted S* suffixes are given."""
    s, with_common = t.s, common is not None
    symbols = np.unique(s)
    number = {int(c): k for k, c in enumerate(symbols)}
    least = np.zeros(len(symbols) if with_common else 1, dtype=np.uint8)
    none = np.zeros(0, dtype=np.uint8)
    seen = least

    def move(queue: SymbolQueue, batch: np.ndarray, lcp: np.ndarray, want_small: bool) -> None:
        before = batch - 1
        ok = before >= 0
        before[~ok] = 0
        ok &= (t.small[before] == want_small) & (s[before] != 0)
        at = np.flatnonzero(ok)
        if with_common:
            behind = np.minimum.accumulate(lcp)
            np.minimum(least, behind[-1], out=least)
        if not len(at):
            return
        target = s[before[at]]
        order = np.argsort(target, kind="stable")
        at, target = at[order], target[order]
        first = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        until = np.append(first[1:], len(at))
        new = none
        if with_common:
            new = np.empty(len(at), dtype=np.uint8)
            which = [number[int(c)] for c in target[first]]
            old = seen[which]
            new[first] = np.minimum(old, behind[at[first]])
            rest = np.ones(len(at), dtype=bool)
            rest[first] = False
            rest = np.flatnonzero(rest)
            if len(rest):
                new[rest] = _range_min(lcp, at[rest - 1] + 1, at[rest])
            new = np.minimum(new, CAP - 1) + np.uint8(1)
            tail = np.minimum.accumulate(lcp[::-1])[::-1]
            ends = at[until - 1] + 1
            least[which] = np.where(ends < len(lcp), tail[np.minimum(ends, len(lcp) - 1)], CAP)
        moved = before[at]
        for k, (lo, hi) in enumerate(zip(first.tolist(), until.tolist(), strict=True)):
            queue.push(int(target[first[k]]), moved[lo:hi], new[lo:hi])

    def feed(queue: SymbolQueue, batch: np.ndarray, lcp: np.ndarray, want_small: bool) -> None:
        nonlocal seen
        if len(batch):
            seen = least.copy()
            move(queue, batch, lcp, want_small)

    def drained(queue: SymbolQueue, c: int, want_small: bool) -> tuple[np.ndarray, np.ndarray]:
        """All of a symbol's list, with what it induces under the same symbol."""
        parts = []
        while len((got := queue.take(c))[0]):
            batch, lcp = got
            if not parts and with_common:
                lcp = lcp.copy()
                lcp[0] = 0
            parts.append((batch, lcp))
            feed(queue, batch, lcp, want_small)
        return (np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])) if parts else (np.zeros(0, dtype=np.int32), none)

    star_symbol = s[stars]
    star_lo, star_hi = np.searchsorted(star_symbol, symbols, "left"), np.searchsorted(star_symbol, symbols, "right")
    large, queue = SymbolQueue(memory), SymbolQueue(memory)
    try:
        for k, c in enumerate(symbols.tolist()):
            part, lcp = drained(queue, c, False)
            if len(part):
                large.push(c, part, lcp)
            own = stars[star_lo[k] : star_hi[k]]
            if len(own):
                down = none
                if with_common:
                    down = common[star_lo[k] : star_hi[k]].copy()
                    down[0] = t.joined(part[-1], own[0]) if len(part) and c else 0
                feed(queue, own, down, False)
        least[:] = 0
        for c in symbols[::-1].tolist():
            if c == 0:
                continue
            part, lcp = drained(queue, c, True)
            own, up = large.take(c)
            if len(own):
                down = none
                if with_common:
                    down = np.append(up[1:], np.uint8(0))[::-1].copy()
                    if len(part):
                        down[0] = t.joined(part[-1], own[-1])
                feed(queue, own[::-1].copy(), down, True)
            if len(part) and with_common:
                back = np.append(np.uint8(t.joined(own[-1], part[-1]) if len(own) else 0), lcp[::-1][:-1])
                up = np.concatenate([up, back])
            if len(own) or len(part):
                yield np.concatenate([own, part[::-1]]), up
    finally:
        large.close()
        queue.close()


def _sweep(t: _Text, key: np.ndarray, edges: np.ndarray, fixed: list[np.ndarray], want_small: bool, memory: int) -> Iterator[np.ndarray]:
    """What the fixed suffixes induce, range by range of rising keys, in order.

    Within a range, suffixes that are already queued come before those that it
    induces itself, and these before the fixed ones; induced ones come in the order
    of the suffixes they are from.  Doubling along these chains settles it.
    """
    queue, none = SymbolQueue(memory), np.zeros(0, dtype=np.uint8)
    try:
        for k, own in enumerate(fixed):
            got, _ = queue.take(k)
            places, kinds, sources = [np.concatenate([got, own])], [np.repeat(np.array([0, 2], dtype=np.int8), [len(got), len(own)])], [np.arange(len(got) + len(own))]
            front, offset = places[0], 0
            while len(front):
                before = front - 1
                ok = before >= 0
                before[~ok] = 0
                ok &= (t.small[before] == want_small) & (t.s[before] != 0) & (key[before] < edges[k + 1])
                at = np.flatnonzero(ok)
                sources.append(at + offset)
                offset += len(front)
                front = before[at]
                places.append(front)
                kinds.append(np.ones(len(front), dtype=np.int8))
            place, kind, source = np.concatenate(places), np.concatenate(kinds), np.concatenate(sources)
            n = len(place)
            if not n:
                yield place
                continue
            arrival = np.where(kind == 1, 0, np.arange(n))
            by = np.lexsort((arrival, kind, key[place]))
            differs = (np.diff(key[place[by]]) != 0) | (np.diff(kind[by]) != 0) | (np.diff(arrival[by]) != 0)
            rank = np.empty(n, dtype=np.int64)
            rank[by] = np.append(0, np.cumsum(differs))
            while rank.max() < n - 1:
                deeper = rank * (n + 1) + rank[source]
                by = np.argsort(deeper, kind="stable")
                rank[by] = np.append(0, np.cumsum(np.diff(deeper[by]) != 0))
                source = source[source]
            by = np.argsort(rank)
            place, kind = place[by], kind[by]
            yield place[kind != 2]
            before = place - 1
            ok = before >= 0
            before[~ok] = 0
            ok &= (t.small[before] == want_small) & (t.s[before] != 0) & (key[before] >= edges[k + 1])
            moved = before[ok]
            to = np.searchsorted(edges, key[moved], "right") - 1
            order = np.argsort(to, kind="stable")
            moved, to = moved[order], to[order]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, dtype=np.int64)
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(to)], strict=False):
                queue.push(int(to[lo]), moved[lo:hi], none)
    finally:
        queue.close()


def _induce_ranges(t: _Text, stars: np.ndarray, memory: int) -> np.ndarray:
    """All suffixes but separators in order, by ranges of symbols of about RANGE suffixes."""
    count = np.bincount(t.s)
    full = np.cumsum(count)
    cuts = np.searchsorted(full, np.arange(RANGE, full[-1], RANGE)) + 1
    edges = np.unique(np.concatenate([[0], cuts, [len(count)]])).astype(np.int64)
    held = SymbolQueue(memory)  # the L suffixes until the second pass
    none = np.zeros(0, dtype=np.uint8)
    at = np.searchsorted(t.s[stars], edges)
    for k, part in enumerate(_sweep(t, t.s, edges, [stars[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)], False, memory)):
        if len(part):
            held.push(k, part, none)
    # the second pass is the first one in a mirror: falling symbols, and L suffixes after the S suffixes of their symbol
    top = len(count) - 1
    mirror, mirrored = (top - t.s).astype(t.s.dtype), (top + 1 - edges[::-1]).astype(np.int64)
    large = [held.take(k)[0] for k in range(len(edges) - 1)]
    held.close()
    small = list(_sweep(t, mirror, mirrored, [x[::-1].copy() for x in reversed(large)], True, memory))
    out = []
    for own, part in zip(large, reversed(small), strict=True):
        both = np.concatenate([own, part[::-1]])
        kind = np.repeat(np.array([0, 1], dtype=np.int8), [len(own), len(part)])
        out.append(both[np.lexsort((np.arange(len(both)), kind, t.s[both]))])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


def _ordered(t: _Text, stars: np.ndarray, memory: int) -> np.ndarray:
    """All suffixes but separators in order."""
    if int(t.s.max()) > SYMBOLS:
        return _induce_ranges(t, stars, memory)
    blocks = [order for order, _ in _induce(t, stars, None, memory)]
    return np.concatenate(blocks[::-1]) if blocks else np.zeros(0, dtype=np.int32)


def _doubled(names: np.ndarray, steps: int) -> np.ndarray:
    """Ranks of the suffixes of names by their first 2**steps symbols or more."""
    rank, n, k = np.unique(names, return_inverse=True)[1].astype(np.int64), len(names), 1
    for _ in range(steps):
        if not n or rank.max() == n - 1:
            break
        after = np.zeros(n, dtype=np.int64)
        after[: max(n - k, 0)] = rank[k:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        k *= 2
    return rank


def _star_order(t: _Text, base: int, memory: int, steps: int) -> np.ndarray:
    """The S* positions in suffix order, separators first in text order."""
    stars = np.flatnonzero(t.star).astype(np.int32)
    real = stars[t.s[stars] != 0]
    marks = stars[t.s[stars] == 0]
    if not len(real):
        return marks
    order = _ordered(t, np.concatenate([marks, real[np.argsort(t.s[real], kind="stable")]]), memory)
    order = order[t.star[order]]
    upto = stars[np.searchsorted(stars, order) + 1]  # a separator follows every real one
    length = upto - order
    same = np.append(False, length[1:] == length[:-1])
    step, live = 0, np.flatnonzero(same).astype(np.int32)
    while len(live):
        live = live[step <= length[live]]
        differs = t.s[order[live] + step] != t.s[order[live - 1] + step]
        # what ends at a separator ends there for good, so such substrings never have one name
        differs |= (step == length[live]) & (t.s[upto[live]] == 0)
        same[live[differs]] = False
        live = live[~differs]
        step += 1
    name = np.empty(t.n, dtype=np.int32)
    name[marks] = np.arange(len(marks))
    name[order] = len(marks) + np.cumsum(~same) - 1
    names = name[stars]
    del name, upto, length, live
    if same.any():
        if len(names) <= base:
            rank = _doubled(names, steps)
        else:  # recursion: names from 1 and a separator at the end, as the first of its symbols
            COUNTS["recursions"] += 1
            sub = _Text(np.append(names + 1, np.int32(0)))
            sorted_sub = _ordered(sub, _star_order(sub, base, memory, steps), memory)
            rank = np.empty(len(names), dtype=np.int32)
            rank[sorted_sub] = np.arange(len(names))
        return stars[np.argsort(rank, kind="stable")]
    return np.concatenate([marks, order])


def _common(t: _Text, order: np.ndarray) -> np.ndarray:
    """Symbols that each S* suffix has in common with the one before it, up to CAP; separators end them."""
    out = np.zeros(len(order), dtype=np.uint8)
    live = np.arange(1, len(order), dtype=np.int32)
    for k in range(CAP):  # neither runs over the end, for a separator stops both
        x = t.s[order[live - 1] + k]
        live = live[(x == t.s[order[live] + k]) & (x != 0)]
        if not len(live):
            break
        out[live] += 1
    return out


def suffix_blocks(text: np.ndarray, ends: np.ndarray, base: int | None = None, memory: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of non-empty segments and the bytes each has in common with the one before it, up to CAP.

    One block for each first byte, from the greatest; within a block suffixes are
    in order, and between blocks they have nothing in common.
    text: the segments' bytes one after another; ends: the end of each.  Suffixes
    are positions in text.  Order is settled as far as CAP bytes at least.
    """
    n, m = len(text), len(ends)
    if not n:
        return
    base, memory = BASE if base is None else base, MEMORY if memory is None else memory
    symbols = np.zeros(n + m, dtype=np.uint16)
    at = np.ones(n + m, dtype=bool)
    at[np.asarray(ends, dtype=np.int64) + np.arange(m)] = False
    symbols[at] = text
    symbols[at] += np.uint16(1)
    del at
    marks = np.asarray(ends, dtype=np.int64) + np.arange(m)
    t = _Text(symbols)
    stars = _star_order(t, base, memory, int(np.ceil(np.log2(CAP))))
    for order, common in _induce(t, stars, _common(t, stars), memory):
        yield order - np.searchsorted(marks, order), common


def suffix_array(text: np.ndarray, ends: np.ndarray, base: int | None = None, memory: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All blocks of suffix_blocks in order."""
    blocks = list(suffix_blocks(text, ends, base, memory))[::-1]
    if not blocks:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    return np.concatenate([o for o, _ in blocks]), np.concatenate([c for _, c in blocks])
