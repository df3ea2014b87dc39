"""Suffix sorting by induction, with common prefixes, in bounded memory.

A text is a sequence of strings, each ended by 0; the ends differ from each other, so no comparison goes beyond one.  The
suffixes that start a rise after a fall are sorted first: the pieces between them are sorted by induction and named, and
the string of names is sorted in turn, by induction again while it is larger than memory.  All other suffixes are then
induced from them: taken in order from a priority queue, a suffix puts the one that starts a character earlier into the
queue under that character, with one more than the smallest common prefix passed since the last one put there.  Queues hold
their tuples in memory up to a limit and beyond it in files sorted by key.
"""

from collections import defaultdict
from collections.abc import Iterator
from tempfile import TemporaryFile

import numpy as np

#: Tuples worked on at once.
CHUNK = 1 << 18
NO_LIMIT = np.iinfo(np.int32).max


def array(size: int, kind: str, limit: int, folder: str | None) -> np.ndarray:
    """In memory up to ``limit`` elements, beyond that in a file without a name that goes with it."""
    if size <= limit:
        return np.zeros(size, kind)
    with TemporaryFile(dir=folder) as file:
        return np.memmap(file, kind, "w+", shape=(size,))


class Spool:
    """A queue of tuples by key; those of one key come back in the order in which they were put.

    As keys are taken in ascending order, and nothing is put under a key that has been passed, it is a priority queue.
    """

    def __init__(self, limit: int, folder: str | None):
        self.limit, self.folder = limit, folder
        self.held: dict[int, list] = defaultdict(list)
        self.size, self.runs = 0, []

    def put(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        """``keys`` ascending."""
        if not len(keys):
            return
        borders = np.flatnonzero(np.diff(keys)) + 1
        for begin, end in zip([0, *borders.tolist()], [*borders.tolist(), len(keys)], strict=True):
            self.held[int(keys[begin])].append([column[begin:end] for column in columns])
        self.size += len(keys)
        if self.size > self.limit:
            self._write()

    def _write(self) -> None:
        order = sorted(self.held)
        sizes = [sum(len(part[0]) for part in self.held[key]) for key in order]
        parts = [part for key in order for part in self.held[key]]
        columns = [np.repeat(order, sizes), *[np.concatenate(column) for column in zip(*parts, strict=True)]]
        stored = []
        for column in columns:
            file = array(len(column), column.dtype.str, 0, self.folder)
            file[:] = column
            stored.append(file)
        self.runs.append([None, *stored])
        self.held.clear()
        self.size = 0

    def take(self, key: int) -> list[list[np.ndarray]]:
        """What has been put under ``key`` since it was last taken, in pieces of at most ``CHUNK`` tuples."""
        parts = []
        for run in self.runs:
            if run[0] != key:
                begin, end = np.searchsorted(run[1], key), np.searchsorted(run[1], key, "right")
                parts += [[column[i : min(i + CHUNK, end)] for column in run[2:]] for i in range(begin, end, CHUNK)]
                run[0] = key
        for part in self.held.pop(key, ()):
            self.size -= len(part[0])
            parts += [[column[i : i + CHUNK] for column in part] for i in range(0, len(part[0]), CHUNK)]
        return _joined(parts)


def _joined(parts: list) -> list:
    """Small neighbouring pieces put together."""
    found, held, size = [], [], 0
    for part in parts:
        if held and size + len(part[0]) > CHUNK:
            found.append([np.concatenate(column) for column in zip(*held, strict=True)])
            held, size = [], 0
        held.append(part)
        size += len(part[0])
    if held:
        found.append([np.concatenate(column) for column in zip(*held, strict=True)])
    return found


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest of ``values[low : high + 1]`` for each pair, from minima over powers of two."""
    power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = [values]
    for k in range(int(power.max(initial=0))):
        half = 1 << k
        last = table[-1]
        table.append(np.minimum(last[:-half], last[half:]))
    found = np.empty(len(low), values.dtype)
    for k in range(len(table)):
        own = np.flatnonzero(power == k)
        found[own] = np.minimum(table[k][low[own]], table[k][high[own] - (1 << k) + 1])
    return found


class _Scan:
    """One pass of induction: suffixes are fed in order, those they induce come out of ``queue`` by their characters."""

    def __init__(self, text: np.ndarray, letters: int, down: bool, with_lcp: bool, limit: int, folder: str | None):
        self.text, self.letters, self.down, self.with_lcp = text, letters, down, with_lcp
        self.queue = Spool(limit, folder)
        if with_lcp:
            self.since = np.full(letters, NO_LIMIT, np.int32)
            self.fresh = np.ones(letters, bool)

    def feed(self, pos: np.ndarray, lcp: np.ndarray, letter: int, equal: bool) -> None:
        """Suffixes that start with ``letter``; ``equal``: those induced may start with the same."""
        before = self.text[pos - 1]  # the first suffix has the last end before it
        if self.down:
            chosen = (before < letter) & (before > 0)
        else:
            chosen = before > letter
        if equal:
            chosen |= (before == letter) & (letter > 0)
        at = np.flatnonzero(chosen)
        if not len(at):
            if self.with_lcp:
                np.minimum(self.since, lcp.min(), out=self.since)
            return
        key = before[at].astype(np.int64)
        if self.down:
            key = self.letters - 1 - key
        order = np.argsort(key.astype(np.uint16) if self.letters <= 1 << 16 else key, kind="stable")
        at, key = at[order], key[order]
        if not self.with_lcp:
            self.queue.put(key, pos[at] - 1, np.zeros(len(at), np.int32))
            return
        first = np.append(True, key[1:] != key[:-1])
        last = np.append(first[1:], True)
        low = np.append(0, at[:-1] + 1)
        low[first] = 0
        least = _range_min(lcp, low, at)
        least[first] = np.minimum(least[first], self.since[key[first]])
        least = np.minimum(least, NO_LIMIT - 1) + 1
        least[first & self.fresh[key]] = 0
        behind = np.append(np.minimum.accumulate(lcp[::-1])[::-1], NO_LIMIT).astype(np.int32)
        np.minimum(self.since, behind[0], out=self.since)
        self.since[key[last]] = behind[at[last] + 1]
        self.fresh[key[last]] = False
        self.queue.put(key, pos[at] - 1, least)


def _run(text: np.ndarray, at: int) -> int:
    """How often the character at ``at`` follows itself; ends of strings stop it."""
    length = 1
    while text[at + length] == text[at]:
        length += 1
    return length


def induce(
    text: np.ndarray, letters: int, seeds: Spool, sorted_seeds: bool, with_lcp: bool, limit: int, folder: str | None
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """All suffixes but the ends, in descending order, in pieces (position, common prefix with the one before, rising).

    ``seeds`` has the suffixes that start a rise after a fall by their first character, (position, common prefix with the
    one before).  If they are not sorted, those of one character count as equal, and what comes out is the order of the pieces
    up to the next seed.
    """
    falling = Spool(limit, folder)
    scan = _Scan(text, letters, False, with_lcp, limit, folder)
    for letter in range(letters):
        last = None
        while parts := scan.queue.take(letter):
            for pos, lcp in parts:
                lcp = np.array(lcp)
                scan.feed(pos, lcp, letter, True)
                falling.put(np.full(len(pos), letter), pos, lcp)
                last = int(pos[-1])
        for pos, lcp in seeds.take(letter):
            lcp = np.array(lcp)
            if last is not None and with_lcp:
                lcp[0] = min(_run(text, last), _run(text, int(pos[0]))) if sorted_seeds else 1
            last = None
            scan.feed(pos, lcp, letter, False)
    scan = _Scan(text, letters, True, with_lcp, limit, folder)
    for letter in range(letters - 1, 0, -1):
        last = None
        while parts := scan.queue.take(letters - 1 - letter):
            for pos, lcp in parts:
                lcp = np.array(lcp)
                scan.feed(pos, lcp, letter, True)
                yield pos, lcp, True
                last = int(pos[-1])
        carried = None
        for pos, lcp in reversed(falling.take(letter)):
            pos, lcp = pos[::-1], lcp[::-1]
            if carried is None:
                carried = min(_run(text, last), _run(text, int(pos[0]))) if last is not None and with_lcp else 0
            shifted = np.append(carried, lcp[:-1]).astype(np.int32)
            carried = lcp[-1]
            scan.feed(pos, shifted, letter, False)
            yield pos, shifted, False


def _sort_in_memory(names: np.ndarray) -> np.ndarray:
    """The rank of each suffix of a string of names that has no two equal suffixes, by doubling."""

    def starts(changes: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(changes, np.arange(len(changes)), 0))

    def changed(values: np.ndarray) -> np.ndarray:
        return np.append(True, values[1:] != values[:-1])

    def shared(changes: np.ndarray) -> np.ndarray:
        return ~(changes & np.append(changes[1:], True))

    order = np.argsort(names, kind="stable")
    new = changed(names[order])
    rank = np.empty(len(names), np.int64)
    rank[order] = starts(new)
    active, step = order[shared(new)], 1
    while len(active):
        second = np.where(active + step < len(names), rank[np.minimum(active + step, len(names) - 1)], -1)
        order = np.lexsort((second, rank[active]))
        active, second = active[order], second[order]
        first = rank[active]
        outer = changed(first)
        new = outer | changed(second)
        rank[active] = first + starts(new) - starts(outer)
        active, step = active[shared(new)], 2 * step
    return rank


def _seeds(text: np.ndarray, limit: int, folder: str | None) -> np.ndarray:
    """Positions, ascending, of suffixes that start a rise after a fall, all ends among them; found from the end in pieces."""
    parts, rising, size = [], True, len(text)
    for begin in reversed(range(0, size, CHUNK)):
        own = np.asarray(text[max(begin - 1, 0) : min(begin + CHUNK + 1, size)]).astype(np.int64)
        here = own[:-1] if begin + CHUNK < size else own
        following = np.append(own[1:], -1)[: len(here)]
        kind = np.where(here == 0, 1, np.sign(following - here))  # 1: rises, -1: falls, 0: as the next one
        known = np.where(kind != 0, np.arange(len(kind)), len(kind))
        known = np.minimum.accumulate(known[::-1])[::-1]
        rises = np.append(kind, 1 if rising else -1)[known] > 0
        at = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
        parts.append(at + max(begin - 1, 0))
        if begin == 0 and rises[0] and here[0] == 0:
            parts.append(np.zeros(1, np.int64))
        rising = bool(rises[1 if begin else 0])
    found = np.concatenate(parts[::-1])
    found.sort()
    stored = array(len(found), "i8", limit, folder)
    stored[:] = found
    return stored


def _ends(text: np.ndarray, seeds: np.ndarray) -> int:
    return sum(int(np.count_nonzero(text[seeds[i : i + CHUNK]] == 0)) for i in range(0, len(seeds), CHUNK))


def _named(text: np.ndarray, letters: int, seeds: np.ndarray, limit: int, folder: str | None) -> tuple[np.ndarray, int]:
    """Names of the pieces from each seed to the next, in their order; ends have names of their own, by their places."""
    spool = Spool(limit, folder)
    for i in range(0, len(seeds), CHUNK):
        own = np.asarray(seeds[i : i + CHUNK])
        letter = np.asarray(text[own]).astype(np.int64)
        order = np.argsort(letter, kind="stable")
        spool.put(letter[order], own[order], np.where(letter[order] == 0, 0, 1).astype(np.int32))
    ends = _ends(text, seeds)
    names = array(len(seeds), "i8", limit, folder)
    name, before, passed = 0, -1, NO_LIMIT
    for pos, lcp, rising in induce(text, letters, spool, False, True, limit, folder):
        if not rising:
            passed = 0  # falling suffixes lie below all rising ones of their character
            continue
        own = np.flatnonzero(text[pos - 1] > text[pos])
        if not len(own):
            passed = min(passed, int(lcp.min()))
            continue
        index = np.searchsorted(seeds, pos[own])
        length = np.asarray(seeds[index + 1]) - np.asarray(seeds[index]) + 1
        common = np.minimum.reduceat(lcp[: own[-1] + 1], np.append(0, own[:-1] + 1))
        common[0] = min(common[0], passed)
        previous = np.append(before, length[:-1])
        different = (common < length) | (length != previous)
        own_names = name + np.cumsum(different)
        names[index] = own_names
        name, before = int(own_names[-1]), int(length[-1])
        passed = int(lcp[own[-1] + 1 :].min(initial=NO_LIMIT))
    at_end = 0
    for i in range(0, len(seeds), CHUNK):
        is_end = np.asarray(text[seeds[i : i + CHUNK]]) == 0
        names[i : i + CHUNK] = np.where(is_end, at_end + np.cumsum(is_end) - 1, ends + name - np.asarray(names[i : i + CHUNK]))
        at_end += int(is_end.sum())
    return names, ends + name


def _ranked(names: np.ndarray, count: int, ends: int, limit: int, folder: str | None) -> np.ndarray:
    """The rank of each suffix of the string of names, whose first ``ends`` names end the strings."""
    if count == len(names):
        return names
    if len(names) <= limit:
        return _sort_in_memory(np.asarray(names))
    inner = array(len(names), "i8", limit, folder)
    inner[:] = np.maximum(np.asarray(names) - ends + 1, 0)
    rank = array(len(names), "i8", limit, folder)
    place = len(names)
    for pos, _, _ in suffixes(inner, count - ends + 1, limit, folder, False):
        rank[pos] = np.arange(place - 1, place - 1 - len(pos), -1)
        place -= len(pos)
    rank[np.flatnonzero(np.asarray(inner) == 0)] = np.arange(place)
    return rank


def _common(text: np.ndarray, seeds: np.ndarray, names: np.ndarray, order: np.ndarray, at: int) -> np.ndarray:
    """The common prefix of a chunk of seeds, in order, with the ones before: whole pieces by their names, then characters."""
    second = np.asarray(order[at : at + CHUNK])
    first = np.append(order[at - 1] if at else second[0], second[:-1])
    x, y = first.copy(), second.copy()
    active = np.arange(0 if at else 1, len(second))
    while len(active):
        active = active[names[x[active]] == names[y[active]]]
        x[active] += 1
        y[active] += 1
    begin = np.asarray(seeds[second])
    x, y = np.array(seeds[x]), np.array(seeds[y])
    active = np.arange(0 if at else 1, len(second))
    while len(active):
        left, right = text[x[active]], text[y[active]]
        active = active[(left == right) & (left > 0)]
        x[active] += 1
        y[active] += 1
    return (y - begin).astype(np.int32)


def suffixes(
    text: np.ndarray, letters: int, limit: int, folder: str | None = None, with_lcp: bool = True
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """All suffixes of ``text`` but the ends, in descending order, in pieces (position, common prefix with the one before, ...).

    ``text`` has values below ``letters``; each string is ended by 0, and so is the text.  ``limit``: tuples a queue, or
    elements an array, may hold in memory.
    """
    seeds = _seeds(text, limit, folder)
    names, count = _named(text, letters, seeds, limit, folder)
    ends = _ends(text, seeds)
    rank = _ranked(names, count, ends, limit, folder)
    order = array(len(seeds), "i8", limit, folder)
    for i in range(0, len(seeds), CHUNK):
        own = rank[i : i + CHUNK]
        order[own] = np.arange(i, i + len(own))
    spool = Spool(limit, folder)
    for i in range(0, len(seeds), CHUNK):
        own = np.asarray(seeds[order[i : i + CHUNK]])
        common = _common(text, seeds, names, order, i) if with_lcp else np.zeros(len(own), np.int32)
        spool.put(np.asarray(text[own]).astype(np.int64), own, common)
    yield from induce(text, letters, spool, True, with_lcp, limit, folder)
