"""External induced suffix sorting with common-prefix values.

A suffix is of type S when it is smaller than the suffix after it, else of type L; an S suffix
after an L suffix is a seed. Sorted seeds induce the order of all others: a pass in rising order
hands the suffix before each one it meets to a priority queue if that is of type L, a pass in
falling order does the same for type S. Seeds are sorted by the same two passes over what lies
between them, named by rank, and, while names repeat, by recursion on the text of names.

The queues hold tuples of a first symbol, a place and a value. What is pushed for a symbol comes
in its final order, so a queue is a list for each range of symbols; lists beyond the room given
are appended to files and read back in parts. The value is the rank of the suffix that induced
this one (equal ranks mean equal seeds' stretches), or, in the last two passes, the length of
the prefix in common with the entry pushed before it for the same symbol: one more than the least
common prefix met since. Texts, types, places and sorted runs are arrays in files. Of a shard of
``n`` symbols memory holds batches, the queues' room and counters for each distinct symbol.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np


#: A symbol, a place and a value. Shards of 2**31 symbols or more need longer ones.
ENTRY = np.dtype([("c", "<u4"), ("p", "<u4"), ("v", "<u4")])
WIDE = np.dtype([("c", "<u4"), ("p", "<i8"), ("v", "<i8")])

#: Entries handled at once, entries queues hold in memory.
BATCH, ROOM = 1 << 18, 1 << 22


class Files:
    """Arrays in memory up to ``memory`` bytes together, beyond that in files of one folder."""

    def __init__(self, folder: str, memory: int = 128 << 20):
        self.folder, self.memory, self.count = folder, memory, 0
        self.held: dict[int, int] = {}
        self.paths: dict[int, str] = {}
        self.entry, self.whole = ENTRY, np.uint32

    def measure(self, symbols: int) -> None:
        """Fix how wide places and ranks are."""
        if symbols >= 1 << 31:
            self.entry, self.whole = WIDE, np.int64

    def path(self) -> str:
        self.count += 1
        return os.path.join(self.folder, f"a{self.count}")

    def array(self, size: int, kind: type | str) -> np.ndarray:
        """A new array of zeros."""
        length = size * np.dtype(kind).itemsize
        if sum(self.held.values()) + length <= self.memory or not size:
            array = np.zeros(size, kind)
            self.held[array.ctypes.data] = length
            return array
        path = self.path()
        # A plain view, as slices of the mapped class are slow.
        array = np.asarray(np.memmap(path, kind, "w+", shape=(size,)))
        self.paths[array.ctypes.data] = path
        return array

    def drop(self, *arrays: np.ndarray) -> None:
        """Forget arrays; their memory goes with the last reference."""
        for array in arrays:
            self.held.pop(array.ctypes.data, None)
            path = self.paths.pop(array.ctypes.data, None)
            if path is not None:
                os.unlink(path)


class Growing:
    """An array that grows at its end, in memory up to ``room`` bytes, then in a file."""

    def __init__(self, files: Files, kind: type, room: int = 32 << 20):
        self.files, self.kind, self.room = files, kind, room
        self.parts: list[np.ndarray] = []
        self.size, self.path = 0, None

    def add(self, array: np.ndarray) -> None:
        self.parts.append(array)
        self.size += array.nbytes
        if self.size > self.room:
            self._write()

    def _write(self) -> None:
        self.path = self.path or self.files.path()
        with open(self.path, "ab") as out:
            for part in self.parts:
                out.write(part.tobytes())
        self.parts = []

    def finish(self) -> np.ndarray:
        if self.path is None:
            return np.concatenate(self.parts)
        self._write()
        return np.asarray(np.memmap(self.path, self.kind, "r"))


class Queue:
    """A list of entries for each range of symbols, in memory up to ``room``, then in files."""

    def __init__(self, files: Files, ranges: int, room: int = ROOM):
        self.files, self.room, self.held = files, room, 0
        self.parts: list[list[np.ndarray]] = [[] for _ in range(ranges)]
        self.paths: dict[int, str] = {}
        self.read = np.zeros(ranges, np.int64)
        self.stored = np.zeros(ranges, np.int64)

    def push(self, at: np.ndarray, entries: np.ndarray) -> None:
        """Append entries to the lists ``at``, keeping their order."""
        if not len(entries):
            return
        # Small integers are sorted by radix.
        order = np.argsort(at.astype(np.uint16) if len(self.parts) < 1 << 16 else at, kind="stable")
        at, entries = at[order], entries[order]
        ends = np.append(np.flatnonzero(at[1:] != at[:-1]) + 1, len(at)).tolist()
        begin = 0
        for end in ends:
            self.parts[int(at[begin])].append(entries[begin:end])
            begin = end
        self.held += len(entries)
        if self.held > self.room:
            self._spill()

    def _spill(self) -> None:
        for at, parts in enumerate(self.parts):
            if parts:
                path = self.paths.setdefault(at, self.files.path())
                with open(path, "ab") as out:
                    for part in parts:
                        out.write(part.tobytes())
                        self.stored[at] += len(part)
                self.parts[at] = []
        self.held = 0

    def pop(self, at: int, limit: int | None = None) -> np.ndarray:
        """The next entries of a list, oldest first; none when it is used up."""
        left = int(self.stored[at] - self.read[at])
        if left:
            count = left if limit is None else min(left, limit)
            kind = self.files.entry
            found = np.fromfile(
                self.paths[at], kind, count, offset=int(self.read[at]) * kind.itemsize
            )
            self.read[at] += count
            if self.read[at] == self.stored[at]:
                os.unlink(self.paths.pop(at))
                self.read[at] = self.stored[at] = 0
            if limit is not None or not self.parts[at]:
                return found
            return np.concatenate([found, self.pop(at)])
        parts, self.parts[at] = self.parts[at], []
        if not parts:
            return np.zeros(0, self.files.entry)
        found = parts[0] if len(parts) == 1 else np.concatenate(parts)
        if limit is not None and len(found) > limit:
            self.parts[at] = [found[limit:]]
            found = found[:limit]
        self.held -= len(found)
        return found


class Run:
    """Places with a value each, appended to a file range by range."""

    def __init__(self, files: Files, ranges: int, size: int):
        self.place = files.array(size, files.whole)
        self.value = files.array(size, files.whole)
        self.begin = np.zeros(ranges, np.int64)
        self.end = np.zeros(ranges, np.int64)
        self.used = 0

    def open(self, at: int) -> None:
        self.begin[at] = self.end[at] = self.used

    def add(self, at: int, place: np.ndarray, value: np.ndarray) -> None:
        to = self.used + len(place)
        self.place[self.used : to] = place
        self.value[self.used : to] = value
        self.used = self.end[at] = to


def kinds(text: np.ndarray, files: Files) -> np.ndarray:
    """1 where the suffix is of type S. The last symbol is the smallest and occurs once."""
    n = len(text)
    small = files.array(n, np.uint8)
    small[n - 1] = 1
    after, kind = text[n - 1], 1
    for high in range(n - 1, 0, -BATCH):
        low = max(0, high - BATCH)
        own = text[low:high].astype(np.int64)
        next_ = np.append(own[1:], np.int64(after))
        # Equal symbols take the type of what follows: look up the next place that differs.
        differs = np.append(own != next_, True)
        where = np.where(differs, np.arange(len(differs)), len(differs))
        where = np.minimum.accumulate(where[::-1])[::-1]
        known = np.append(own < next_, bool(kind))
        small[low:high] = known[where[:-1]]
        after, kind = own[0], small[low]
    return small


def seeds_of(small: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the seeds, in the order of the text."""
    for low in range(1, len(small), BATCH):
        own = np.asarray(small[low - 1 : low + BATCH])
        yield low + np.flatnonzero((own[1:] == 1) & (own[:-1] == 0))


class Ranges:
    """Ranges of symbols with about a batch of suffixes each; ``single``: a range a symbol."""

    def __init__(self, text: np.ndarray, single: bool):
        count = np.zeros(1, np.int64)
        for low in range(0, len(text), BATCH):
            own = np.bincount(text[low : low + BATCH])
            if len(own) > len(count):
                count = np.append(count, np.zeros(len(own) - len(count), np.int64))
            count[: len(own)] += own
        self.symbols = len(count)
        if single:
            self.first = np.arange(self.symbols)
        else:
            # A symbol with more than a batch has a range of its own.
            total = np.cumsum(count) - count
            group = total // BATCH
            large = count > BATCH
            fresh = np.ones(self.symbols, bool)
            fresh[1:] = (group[1:] != group[:-1]) | large[1:] | large[:-1]
            self.first = np.flatnonzero(fresh)
        self.end = np.append(self.first[1:], self.symbols)
        self.count = len(self.first)

    def of(self, symbol: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, symbol, side="right") - 1


def _count(small: np.ndarray, kind: bool) -> int:
    """Suffixes of a type."""
    ones = sum(int(small[low : low + BATCH].sum()) for low in range(0, len(small), BATCH))
    return ones if kind else len(small) - ones


class Pass:
    """One pass over all suffixes in rising order, or, ``falling``, in falling order.

    Symbols are counted down in a falling pass, so both run the same way. ``seeds`` has what
    the pass meets besides the suffixes it induces, after those of the same symbol.
    """

    def __init__(
        self, text: np.ndarray, small: np.ndarray, ranges: Ranges, seeds: Callable[[int], Queue],
        files: Files, falling: bool, common: Callable | None = None,
    ):
        self.text, self.small, self.ranges, self.falling = text, small, ranges, falling
        self.seeds, self.common = seeds, common
        self.files, self.queue = files, Queue(files, ranges.count)
        self.out = Run(files, ranges.count, _count(small, falling))
        self.rank = 0
        self.low = np.full(ranges.symbols, 1 << 20, np.int64)

    def run(self) -> Run:
        order = range(self.ranges.count)
        for at in reversed(order) if self.falling else order:
            self.out.open(at)
            first, end = int(self.ranges.first[at]), int(self.ranges.end[at])
            if end - first == 1:
                self._symbol(at)
            else:
                self._several(at, first, end)
        return self.out

    def _before(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which entries have a suffix before them of the wanted type, those and their symbols."""
        before = place.astype(np.int64) - 1
        has = before >= 0
        wanted = np.zeros(len(place), bool)
        wanted[has] = self.small[before[has]] == self.falling
        before = before[wanted]
        return wanted, before, np.asarray(self.text[before])

    # One symbol: its list is in order already, and what it adds to itself comes at the end.

    def _symbol(self, at: int) -> None:
        last = None
        while len(entries := self.queue.pop(at, BATCH)):
            last = self._batch(at, entries, last, False)
        seeds = self.seeds(at)
        while len(entries := seeds.pop(at, BATCH)):
            last = self._batch(at, entries, last, True)

    def _batch(self, at: int, entries: np.ndarray, last: tuple | None, seed: bool) -> tuple:
        """Pass over entries; ``last`` is ``(place, value, seed)`` of the one before them."""
        value = entries["v"].astype(np.int64)
        if self.common is None:
            fresh = np.ones(len(entries), bool)
            fresh[1:] = value[1:] != value[:-1]
            if last is not None and last[2] == seed:
                fresh[0] = int(value[0]) != last[1]
            own = self.rank + np.cumsum(fresh)
            self.rank = int(own[-1])
        else:
            if last is None:
                value[0] = 0
            elif last[2] != seed:
                value[0] = self.common(np.array([last[0]]), entries["p"][:1])[0]
            own = value
        if not seed:
            self.out.add(at, entries["p"], own)
        wanted, before, symbol = self._before(entries["p"])
        pushed = np.empty(len(before), self.files.entry)
        pushed["c"], pushed["p"] = symbol, before
        if self.common is None:
            pushed["v"] = own[wanted]
        else:
            pushed["v"] = 1 + self._least(value, np.flatnonzero(wanted), symbol)
        self.queue.push(self.ranges.of(symbol), pushed)
        return int(entries["p"][-1]), int(entries["v"][-1]), seed

    def _least(self, value: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The least of ``value`` since the push before for the same symbol, for each push."""
        tables = [value]
        while 2 << (len(tables) - 1) <= len(value):
            step = 1 << (len(tables) - 1)
            tables.append(np.minimum(tables[-1][:-step], tables[-1][step:]))

        def least(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            size = high - low + 1
            level = np.frexp(size.astype(float))[1] - 1
            found = np.empty(len(low), np.int64)
            for i in np.unique(level):
                own = level == i
                found[own] = np.minimum(tables[i][low[own]], tables[i][high[own] - (1 << i) + 1])
            return found

        order = np.argsort(symbol.astype(np.uint16), kind="stable")
        place, own = at[order], symbol[order].astype(np.int64)
        first = np.ones(len(place), bool)
        first[1:] = own[1:] != own[:-1]
        previous = np.where(first, -1, np.append(-1, place[:-1]) if len(place) else place)
        found = least(previous + 1, place) if len(place) else np.zeros(0, np.int64)
        found[first] = np.minimum(found[first], self.low[own[first]])
        self.low = np.minimum(self.low, value.min())
        # For symbols that were pushed the count begins anew after their last push.
        final = np.append(np.flatnonzero(first)[1:], len(place)) - 1 if len(place) else place
        rest = place[final] < len(value) - 1
        self.low[own[final]] = 1 << 20
        some = final[rest]
        if len(some):
            self.low[own[some]] = least(place[some] + 1, np.full(len(some), len(value) - 1))
        result = np.empty(len(place), np.int64)
        result[order] = found
        return result

    # Several symbols: all entries of the range, those it adds to itself included, are sorted
    # by the symbols on the way to where each came from.

    def _several(self, at: int, first: int, end: int) -> None:
        seeds = self.seeds(at).pop(at)
        self.queue.push(*self._routed(self._solve(at, first, end, self.queue.pop(at), seeds)))

    def _routed(self, pushed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.ranges.of(pushed["c"]), pushed

    def _turn(self, symbol: np.ndarray) -> np.ndarray:
        symbol = symbol.astype(np.int64)
        return self.ranges.symbols - 1 - symbol if self.falling else symbol

    def _solve(
        self, at: int, first: int, end: int, entries: np.ndarray, seeds: np.ndarray
    ) -> np.ndarray:
        """Pass over the symbols ``first`` to ``end - 1``; returns what is pushed beyond them."""
        if not len(entries) and not len(seeds):
            return np.zeros(0, self.files.entry)
        base = self.ranges.symbols - end if self.falling else first
        own = np.concatenate([entries["c"], seeds["c"]])
        kind = np.repeat([0, 2], [len(entries), len(seeds)])
        place, code = [np.concatenate([entries["p"], seeds["p"]])], [(self._turn(own) - base) * 3 + kind]
        parent, begin = [np.arange(len(own))], 0
        while True:
            wanted, before, own = self._before(place[-1])
            inside = (own >= first) & (own < end)
            if not inside.any():
                break
            parent.append(begin + np.flatnonzero(wanted)[inside])
            begin += len(place[-1])
            place.append(before[inside])
            code.append((self._turn(own[inside]) - base) * 3 + 1)
        depth = np.repeat(np.arange(len(place)), [len(x) for x in place])
        place, code, parent = (np.concatenate(x) for x in (place, code, parent))
        order = self._ordered(code, parent, len(entries) + len(seeds))
        value = np.concatenate([entries["v"], seeds["v"]])
        rank = self._ranked(order, code, parent, depth, value)
        place = place[order]
        induced = code[order] % 3 != 2
        self.out.add(at, place[induced], rank[induced])
        wanted, before, own = self._before(place)
        beyond = (own < first) | (own >= end)
        pushed = np.empty(int(beyond.sum()), self.files.entry)
        pushed["c"], pushed["p"], pushed["v"] = own[beyond], before[beyond], rank[wanted][beyond]
        return pushed

    @staticmethod
    def _ordered(code: np.ndarray, parent: np.ndarray, roots: int) -> np.ndarray:
        """Entries by their symbols and those on the way to where they came from, which the
        order of the first ``roots`` ends. Ranks by so many symbols give those by twice as many.
        """
        count = len(code)
        if count == roots:
            small = code.astype(np.uint16) if code.max() < 1 << 16 else code
            return np.argsort(small, kind="stable")
        key = code * (roots + 1)
        key[:roots] += np.arange(roots)
        jump = parent
        while True:
            found, rank = np.unique(key, return_inverse=True)
            if len(found) == count:
                order = np.empty(count, np.int64)
                order[rank] = np.arange(count)
                return order
            key = rank * count + rank[jump]
            jump = jump[jump]

    def _ranked(
        self, order: np.ndarray, code: np.ndarray, parent: np.ndarray, depth: np.ndarray, value: np.ndarray
    ) -> np.ndarray:
        """Ranks in order; equal for entries of equal symbols, ways and values of the roots."""
        fresh = np.ones(len(order), bool)
        same = np.zeros(len(order), bool)
        same[1:] = (code[order[1:]] == code[order[:-1]]) & (depth[order[1:]] == depth[order[:-1]])
        group = np.empty(len(order), np.int64)
        levels = np.argsort(depth[order], kind="stable")
        ends = np.cumsum(np.bincount(depth))
        begin = 0
        for level, end in enumerate(ends.tolist()):
            at = levels[begin:end]
            own = order[at]
            source = value[own] if level == 0 else group[parent[own]]
            alike = same[at].copy()
            alike[0] = False
            alike[1:] &= source[1:] == source[:-1]
            fresh[at] = ~alike
            group[own] = np.cumsum(~alike)
            begin = end
        rank = self.rank + np.cumsum(fresh)
        self.rank = int(rank[-1])
        return rank


def _seed_queue(
    places: Iterator[np.ndarray], values: Callable, text: np.ndarray, ranges: Ranges, files: Files
) -> Queue:
    queue = Queue(files, ranges.count)
    for place in places:
        entries = np.empty(len(place), files.entry)
        entries["c"], entries["p"], entries["v"] = text[place], place, values(place)
        queue.push(ranges.of(entries["c"]), entries)
    return queue


def _falling_seeds(out: Run, text: np.ndarray, files: Files, ranges: int, shift: bool) -> Callable:
    """The entries of a rising pass, last first; ``shift`` moves values on by one place."""

    def of(at: int) -> Queue:
        queue = Queue(files, ranges)
        low, high = int(out.begin[at]), int(out.end[at])
        carried = 0
        for end in range(high, low, -BATCH):
            begin = max(low, end - BATCH)
            entries = np.empty(end - begin, files.entry)
            entries["p"] = out.place[begin:end][::-1]
            entries["c"] = text[entries["p"]]
            value = out.value[begin:end][::-1]
            if shift:
                value, carried = np.append(carried, value[:-1]), value[-1]
            entries["v"] = value
            queue.push(np.full(len(entries), at), entries)
        return queue

    return of


def _named(
    out: Run, small: np.ndarray, ranges: Ranges, files: Files
) -> tuple[np.ndarray, int, int]:
    """Names of the seeds in the order of the text, how many seeds, how many names.

    Equal names mean equal stretches up to the next seed; names are ranks of these.
    """
    slots = files.array(len(small) // 2 + 1, files.whole)
    slots[(len(small) - 1) // 2] = 1  # the last symbol
    name, last, seeds = 1, None, 1
    for at in range(ranges.count):
        low, high = int(out.begin[at]), int(out.end[at])
        for end in range(high, low, -BATCH):
            begin = max(low, end - BATCH)
            place = out.place[begin:end][::-1].astype(np.int64)
            rank = out.value[begin:end][::-1]
            seed = (place > 0) & (small[place - 1] == 0)
            place, rank = place[seed], rank[seed]
            if not len(place):
                continue
            fresh = np.ones(len(place), bool)
            fresh[1:] = rank[1:] != rank[:-1]
            fresh[0] = rank[0] != last
            names = name + np.cumsum(fresh)
            slots[place // 2] = names
            name, last, seeds = int(names[-1]), rank[-1], seeds + len(place)
    return slots, seeds, name


def _reduced(slots: np.ndarray, seeds: int, names: int, files: Files) -> np.ndarray:
    text = files.array(seeds, np.uint32)
    used = 0
    for low in range(0, len(slots), BATCH):
        own = np.asarray(slots[low : low + BATCH])
        own = own[own > 0] - 1
        text[used : used + len(own)] = own
        used += len(own)
    return text


def _sorted_seeds(
    text: np.ndarray, small: np.ndarray, ranges: Ranges, files: Files
) -> np.ndarray:
    """The places of all seeds in the order of their suffixes."""
    queue = _seed_queue(seeds_of(small), lambda p: 0, text, ranges, files)
    rising = Pass(text, small, ranges, lambda at: queue, files, False).run()
    back = _falling_seeds(rising, text, files, ranges.count, False)
    falling = Pass(text, small, ranges, back, files, True).run()
    files.drop(rising.place, rising.value)
    slots, seeds, names = _named(falling, small, ranges, files)
    files.drop(falling.place, falling.value)
    reduced = _reduced(slots, seeds, names, files)
    files.drop(slots)
    if names == seeds:
        order = files.array(seeds, files.whole)
        for low in range(0, seeds, BATCH):
            own = np.asarray(reduced[low : low + BATCH])
            order[own] = np.arange(low, low + len(own))
    else:
        order = suffix_array(reduced, files)
    files.drop(reduced)
    places, used = files.array(seeds, files.whole), 0
    for own in seeds_of(small):
        places[used : used + len(own)] = own
        used += len(own)
    result = files.array(seeds, files.whole)
    for low in range(0, seeds, BATCH):
        result[low : low + BATCH] = places[order[low : low + BATCH]]
    files.drop(places, order)
    return result


def _merged(
    rising: Run, falling: Run, text: np.ndarray, ranges: Ranges, at: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places of a range of several symbols in their order."""
    large = np.asarray(rising.place[rising.begin[at] : rising.end[at]])
    small = np.asarray(falling.place[falling.begin[at] : falling.end[at]])[::-1]
    place = np.concatenate([large, small])
    kind = np.repeat([0, 1], [len(large), len(small)])
    return place[np.argsort(text[place].astype(np.int64) * 2 + kind, kind="stable")]


def suffix_array(text: np.ndarray, files: Files) -> np.ndarray:
    """All places of ``text`` in the order of their suffixes; the last symbol is its smallest."""
    n = len(text)
    small = kinds(text, files)
    ranges = Ranges(text, False)
    order = _sorted_seeds(text, small, ranges, files)
    parts = (order[low : low + BATCH].astype(np.int64) for low in range(0, len(order), BATCH))
    queue = _seed_queue(parts, lambda p: 0, text, ranges, files)
    files.drop(order)
    rising = Pass(text, small, ranges, lambda at: queue, files, False).run()
    back = _falling_seeds(rising, text, files, ranges.count, False)
    falling = Pass(text, small, ranges, back, files, True).run()
    result, used = files.array(n, files.whole), 1
    result[0] = n - 1
    for at in range(ranges.count):
        if ranges.end[at] - ranges.first[at] > 1:
            own = _merged(rising, falling, text, ranges, at)
            result[used : used + len(own)] = own
            used += len(own)
            continue
        for run, step in ((rising, 1), (falling, -1)):
            low, high = int(run.begin[at]), int(run.end[at])
            for begin in range(low, high, BATCH):
                end = min(high, begin + BATCH)
                own = run.place[begin:end]
                if step < 0:
                    own = run.place[high - (end - low) : high - (begin - low)][::-1]
                result[used : used + len(own)] = own
                used += len(own)
    files.drop(small, rising.place, rising.value, falling.place, falling.value)
    return result


def sorted_suffixes(
    text: np.ndarray, most: int, files: Files
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all suffixes in order, with the symbols each shares with the one before it.

    ``text`` holds 16-bit symbols, the last one the smallest and alone; ``most + 4`` readable
    symbols follow it in its file. Common prefixes count up to ``most``.
    """
    n = len(text) - most - 4
    whole, text = text, text[:n]
    words = np.ndarray((n + most,), "<u8", buffer=whole.data, strides=(2,))

    def common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = np.full(len(left), most, np.int64)
        at = np.arange(len(left))
        for step in range(0, most, 4):
            differ = words[left[at] + step] ^ words[right[at] + step]
            done = differ != 0
            lowest = differ[done] & (~differ[done] + np.uint64(1))
            found[at[done]] = step + (np.frexp(lowest.astype(float))[1] - 1) // 16
            at = at[~done]
            if not len(at):
                break
        return np.minimum(found, most)

    files.measure(n)
    small = kinds(text, files)
    ranges = Ranges(text, True)
    order = _sorted_seeds(text, small, ranges, files)
    last = [np.zeros(0, np.int64)]

    def between(place: np.ndarray) -> np.ndarray:
        """What each seed shares with the one before it."""
        before = np.append(last[0], place[:-1]) if len(last[0]) else np.append(place[:1], place[:-1])
        last[0] = place[-1:].copy()
        return common(before, place)

    parts = (order[low : low + BATCH].astype(np.int64) for low in range(0, len(order), BATCH))
    queue = _seed_queue(parts, between, text, ranges, files)
    files.drop(order)
    cut = lambda left, right: common(left, right)
    rising = Pass(text, small, ranges, lambda at: queue, files, False, cut).run()
    back = _falling_seeds(rising, text, files, ranges.count, True)
    falling = Pass(text, small, ranges, back, files, True, cut).run()
    yield np.array([n - 1]), np.zeros(1, np.int64)
    for at in range(ranges.count):
        before = None
        low, high = int(rising.begin[at]), int(rising.end[at])
        for begin in range(low, high, BATCH):
            place = rising.place[begin : min(high, begin + BATCH)].astype(np.int64)
            value = rising.value[begin : min(high, begin + BATCH)].astype(np.int64)
            if before is None:
                value[0] = 0
            before = place[-1:]
            yield place, np.minimum(value, most)
        low, high = int(falling.begin[at]), int(falling.end[at])
        for end in range(high, low, -BATCH):
            begin = max(low, end - BATCH)
            place = falling.place[begin:end][::-1].astype(np.int64)
            # In a falling pass a value belongs to an entry and the one before it, which is larger.
            value = np.empty(end - begin, np.int64)
            value[1:] = falling.value[begin:end][::-1][:-1]
            if end < high:
                value[0] = falling.value[end]
            else:
                value[0] = 0 if before is None else cut(before, place[:1])[0]
            yield place, np.minimum(value, most)
    files.drop(small, rising.place, rising.value, falling.place, falling.value)
