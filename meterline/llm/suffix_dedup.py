"""Removing repeated byte strings by sorting suffixes, shard by shard, on disk where a shard is larger than memory.

Every byte of a text that lies in a string of ``LEAST`` bytes which also starts in a document with a smaller id is removed.

1. Each window of ``LEAST`` bytes is represented by the smallest hash of the ``KMER``-byte strings in it, so equal windows have
   equal hashes.  Neighbouring windows of one hash are a run, some 15 on the average, with the string that they cover.
2. The hashes, with a digest of the run's string and of the hashes beside it, are counted in buckets.  A hash of one document is
   done with; one whose digests are all equal needs no further comparison; the others are mixed.  All tasks learn of which
   kind a hash is from bits, at most ``MOST_BITS`` of each kind; a bit set by another hash costs a comparison and changes nothing.
3. Neighbouring runs that are not mixed have the same neighbours wherever they occur, so they go on as one, with the hash of
   the first.  The runs of a repeated hash meet in one shard, of mixed ones with their strings.  Strings that share with no
   other one the hash's bytes and those around it that a common window would have are told without sorting.  The others
   are sorted by all their suffixes (:mod:`meterline.llm.induced`); suffixes that share ``LEAST`` bytes stand beside each other and
   get the smallest id of their documents.
4. A hash in more than ``HOT`` documents is no single shard's: of its strings the different ones are kept, with their
   smallest ids, and their windows are grouped by content.
5. Spans are packed by texts, joined where they meet and go back to the documents.

Hashes, runs and spans travel as packed columns, one row for some megabytes of text and a bucket or shard; texts
without spans are left where they are.

Rows: a NULL text is empty; texts shorter than ``LEAST`` lose nothing.  A row without id counts as coming after all ids, and
rows of one id, equal or not, take nothing from each other.  Texts of any length are read in pieces that overlap.  Bytes
are those of UTF-8, so what is kept can begin or end inside a character; it is binary.
"""

import os
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from tempfile import SpooledTemporaryFile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import partitions, small, written
from meterline.llm.induced import CHUNK, array, suffixes

LEAST = 50
KMER = 20
#: Windows that are worked on at once, and bytes of texts whose runs are packed together.
PIECE = 1 << 16
TOGETHER = 1 << 24
#: Documents of one hash up to which its runs meet in one shard: some 10 MB of strings and numbers.
HOT = 100_000
#: Buckets of hashes, and shards of runs, for each partition of a shuffle.
BUCKETS, SHARDS = 4, 2
#: Leading bits of a hash that are counted, and how many are looked up: 64 MB of bits for each of two kinds at most.
HASH_BITS = 48
MOST_BITS, BITS_A_HASH, FEWEST_BITS = 29, 32, 20
#: Tuples that a queue of the sorter, and elements that an array, may hold in memory.
IN_MEMORY = 1 << 26
#: Windows of occurrences that are compared at once, bytes of strings that are looked at together, and spans packed together.
COMPARED = 1 << 21
SEEN = 1 << 18
PACKED = 1 << 20
#: Jobs in which the bits come to the driver.
PARTS_OF_BITS = 24
NO_ID = np.iinfo(np.int64).max
MIXED, CROWDED = 1, 2

COUNTS = "bucket bigint, hashes binary, digests binary, docs binary"
KINDS = "bucket bigint, hashes binary, kinds binary"
#: Numbers of a run, and how many bytes of each are sent.
NUMBERS = {"doc": 8, "text_hash": 8, "start": 8, "windows": 8, "hash": HASH_BITS // 8}
RUNS = "shard bigint, doc binary, text_hash binary, start binary, windows binary, hash binary, mixed binary, strings binary"
HOT_RUNS = "doc bigint, text_hash bigint, start bigint, end bigint, hash bigint, string binary"
SPAN = ("doc", "text_hash", "start", "end")
PACKED_SPANS = "part bigint, doc binary, text_hash binary, start binary, end binary"
SPANS = "doc bigint, text_hash bigint, spans binary"


def _sliding(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values."""
    size, least = 1, values
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(values) - width + 1
    return np.minimum(least[:n], least[width - size : width - size + n])


def _kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` neighbouring bytes, put together from those of powers of two."""
    power = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    n, size, offset, found, factor = len(data) - k + 1, 1, 0, None, 0xD6E8FEB86659FD93
    while size <= k:
        if k & size:
            part = power[offset : offset + n]
            found = part.copy() if found is None else found * np.uint64(0x2545F4914F6CDD1D) + part
            offset += size
        if size * 2 <= k:
            power = power[:-size] * np.uint64(factor) + power[size:]
            factor = (factor * factor * 3 + 2) % (1 << 64)
        size *= 2
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def window_runs(texts: list[bytes], least: int = LEAST, k: int = KMER) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each piece of the joined texts: where it begins in them, then of each run its text, first and last window, and hash.

    Windows count from the beginning of the joined texts; none goes over the end of a text.
    """
    whole = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(text) for text in texts])
    starts = np.append(0, ends[:-1])
    for begin in range(0, len(whole) - least + 1, PIECE):
        hashes = _sliding(_kmer_hashes(whole[begin : begin + PIECE + least - 1], k), least - k + 1)
        inside = np.ones(len(hashes), bool)
        a, b = np.searchsorted(ends, (begin, begin + len(hashes) + least))
        for end in (ends[a : b + 1] - begin).tolist():
            inside[max(end - least + 1, 0) : max(end, 0)] = False
        change = np.append(True, (hashes[1:] != hashes[:-1]) | ~inside[:-1])
        first = np.flatnonzero(change & inside)
        last = np.flatnonzero(inside & np.append(change[1:] | ~inside[1:], True))
        # Smallest hashes lie near zero; buckets, shards and bits need them spread again.
        spread = hashes[first] * np.uint64(0xFF51AFD7ED558CCD)
        spread = (spread ^ (spread >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        text = np.searchsorted(starts, first + begin, "right") - 1
        yield begin, text, first + begin, last + begin, spread ^ (spread >> np.uint64(33))


def _together(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows again, in tables of some megabytes of text or of one text."""
    for batch in batches:
        sizes = np.cumsum([len(data) for data in batch["data"]])
        groups = sizes // TOGETHER
        for a, b in zip(border := [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist()], [*border[1:], len(batch)], strict=True):
            if b > a:
                yield batch.iloc[a:b]


def _powers(factor: int, n: int) -> np.ndarray:
    found = np.full(n, factor, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


class Digests:
    """64-bit digests of parts of a text from one running sum: bytes stand for fixed odd numbers, places for powers."""

    FACTOR = 0xD1342543DE82EF95

    def __init__(self, least: int):
        size = PIECE + least
        self.values = np.random.default_rng(12).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = _powers(self.FACTOR, size)
        self.down = _powers(pow(self.FACTOR, -1, 1 << 64), size)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.down[starts]
        found ^= found >> np.uint64(31)
        return found * np.uint64(0xBF58476D1CE4E5B9) ^ (ends - starts).astype(np.uint64)


def _spill_folder() -> str | None:
    """Where Spark's own tasks spill; files there have no name and go with the task."""
    return os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each group of equal neighbours begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def _rows_of_bytes(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of numbers, all first bytes, then all second ones: the leading ones repeat themselves."""
    return _rows_of_bytes(values)[:, :width].T.tobytes()


def _from_planes(blobs: Iterable[bytes], width: int) -> np.ndarray:
    parts = [np.frombuffer(blob, np.uint8).reshape(width, -1).T for blob in blobs]
    found = np.zeros((sum(map(len, parts)), 8), np.uint8)
    np.concatenate(parts, out=found[:, :width]) if parts else None
    return found.view("<u8").ravel()


def _packed(groups: np.ndarray, columns: dict[str, np.ndarray], name: str, planes: dict[str, int]) -> pd.DataFrame:
    """A row for each group, its values of each column as bytes, those in ``planes`` in so many; ``groups`` ascending."""
    begin = _firsts(groups)
    borders = list(zip(begin.tolist(), [*begin[1:].tolist(), len(groups)], strict=True))
    packed = {}
    for column, values in columns.items():
        if column in planes:
            rows = _rows_of_bytes(values)[:, : planes[column]]
            packed[column] = [rows[a:b].T.tobytes() for a, b in borders]
        else:
            packed[column] = [values[a:b].tobytes() for a, b in borders]
    return pd.DataFrame({name: groups[begin].astype(np.int64), **packed})


def _with_neighbours(digests: np.ndarray, hashes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Digests of runs in their order, each put together with the hashes of the runs before and after it in its text."""
    found, same = digests * np.uint64(0x9FB21C651E98DF25), texts[1:] == texts[:-1]
    found[1:] += np.where(same, hashes[:-1], 0) * np.uint64(0xC2B2AE3D27D4EB4F)
    found[:-1] += np.where(same, hashes[1:], 0) * np.uint64(0x165667B19E3779F9)
    found ^= found >> np.uint64(31)
    return found * np.uint64(0xBF58476D1CE4E5B9)


def _hash_counter(least: int, bits: int) -> Callable:
    """Each hash and digest with the number of documents, for some megabytes of texts at a time."""

    def counted(hashes: np.ndarray, digests: np.ndarray, texts: np.ndarray) -> pd.DataFrame:
        order = np.argsort(hashes)
        hashes, digests, texts = hashes[order], digests[order], texts[order]
        same = hashes[1:] == hashes[:-1]
        shared = np.flatnonzero(np.append(same, False) | np.append(False, same))
        order = shared[np.lexsort((texts[shared], digests[shared], hashes[shared]))]
        digests[shared], texts[shared] = digests[order], texts[order]
        new = np.append(True, ~same | (digests[1:] != digests[:-1]))
        new_text = new | np.append(True, texts[1:] != texts[:-1])
        first = np.flatnonzero(new)
        docs = np.minimum(np.add.reduceat(new_text.astype(np.int64), first), 65535).astype("<u2")
        hashes = hashes[first]
        columns = {"hashes": hashes, "digests": digests[first].astype("<u8"), "docs": docs}
        return _packed(hashes >> np.uint64(HASH_BITS - bits), columns, "bucket", {"hashes": HASH_BITS // 8})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = Digests(least)
        for batch in _together(batches):
            texts = batch["data"].tolist()
            whole, held = np.frombuffer(b"".join(texts), np.uint8), []
            for begin, text, first, last, hashes in window_runs(texts, least):
                own = digest(whole[begin : begin + PIECE + least - 1], first - begin, last + least - begin)
                held.append((hashes, own, text))
            if sum(len(own[0]) for own in held):
                hashes, own, text = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                yield counted(hashes >> np.uint64(64 - HASH_BITS), _with_neighbours(own, hashes, text), text)

    return run


def _judge(hot: int) -> Callable:
    """Of a bucket's hashes those in several documents, or with several digests, and of which kind they are."""

    def run(own: pd.DataFrame) -> pd.DataFrame:
        hashes = _from_planes(own["hashes"], HASH_BITS // 8)
        digests, docs = (np.frombuffer(b"".join(own[c]), kind) for c, kind in (("digests", "<u8"), ("docs", "<u2")))
        order = np.argsort(hashes)
        hashes, digests, docs = hashes[order], digests[order], docs[order]
        first = _firsts(hashes)
        total = np.add.reduceat(docs.astype(np.int64), first)
        mixed = np.maximum.reduceat(digests, first) != np.minimum.reduceat(digests, first)
        kinds = mixed * MIXED + (total > hot) * CROWDED
        chosen = np.flatnonzero(total > 1)
        rows = {"hashes": [_planes(hashes[first[chosen]], HASH_BITS // 8)], "kinds": [kinds[chosen].astype(np.uint8).tobytes()]}
        return pd.DataFrame({"bucket": own["bucket"].iloc[:1].to_numpy(), **rows})

    return run


def _bits(kinds: DataFrame, bits: int, hashes: int) -> tuple[int, bytes, bytes, bytes]:
    """How many leading bits of a hash are looked up, for each value whether a repeated or mixed hash has it, the crowded hashes.

    ``bits``: those that name a bucket.
    """
    width = max(bits + 3, FEWEST_BITS)
    while width < MOST_BITS and 1 << width < BITS_A_HASH * hashes:
        width += 1
    size = 1 << (width - bits)

    def fill(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for bucket, blob, kind in zip(batch["bucket"], batch["hashes"], batch["kinds"], strict=True):
                hashes, kind = _from_planes([blob], HASH_BITS // 8), np.frombuffer(kind, np.uint8)
                place = (hashes >> np.uint64(HASH_BITS - width)) & np.uint64(size - 1)
                own = [bucket]
                for chosen in (place, place[kind & MIXED > 0]):
                    flags = np.zeros(size, bool)
                    flags[chosen] = True
                    own.append(np.packbits(flags, bitorder="little").tobytes())
                rows.append([*own, hashes[kind & CROWDED > 0].tobytes()])
            yield pd.DataFrame(rows, columns=["bucket", "repeated", "mixed", "crowded"])

    found, crowded = [bytearray(1 << (width - 3)) for _ in range(2)], []
    schema = "bucket bigint, repeated binary, mixed binary, crowded binary"
    for row in kinds.coalesce(PARTS_OF_BITS).mapInPandas(fill, schema).toLocalIterator():
        at = row["bucket"] * (size >> 3)
        for whole, own in zip(found, row[1:3], strict=True):
            whole[at : at + len(own)] = own
        crowded.append(row["crowded"])
    return width, *map(bytes, found), np.sort(np.frombuffer(b"".join(crowded), "<u8")).tobytes()


class _Kinds:
    """The kinds of all hashes, in a task."""

    def __init__(self, bits):
        self.width, *kinds, crowded = bits.value
        self.repeated, self.mixed = (np.frombuffer(own, np.uint8) for own in kinds)
        self.crowded = np.append(np.frombuffer(crowded, "<u8"), np.uint64(1 << 63))

    def is_set(self, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - self.width)
        return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def is_crowded(self, hashes: np.ndarray) -> np.ndarray:
        counted = hashes >> np.uint64(64 - HASH_BITS)
        return self.crowded[np.searchsorted(self.crowded, counted)] == counted

    def runs(self, texts: list[bytes], least: int, crowded: bool) -> tuple[np.ndarray, ...]:
        """Runs of repeated hashes, crowded ones or the others: text, first and last window, hash, whether it is mixed.

        Neighbours that are not mixed are one, as each of their hashes has the other beside it wherever it occurs.
        """
        held = [[np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)]]
        for _, *own, hashes in window_runs(texts, least):
            chosen = np.flatnonzero(self.is_set(self.repeated, hashes))
            chosen = chosen[self.is_crowded(hashes[chosen]) == crowded]
            held.append([x[chosen] for x in (*own, hashes)])
        text, first, last, hashes = (np.concatenate(x) for x in zip(*held, strict=True))
        del held  # some 30 MB, as much as what has been put together
        mixed = self.is_set(self.mixed, hashes)
        follows = ~mixed[1:] & ~mixed[:-1] & (text[1:] == text[:-1]) & (first[1:] == last[:-1] + 1)
        begins, ends = (np.append(True, ~follows), np.append(~follows, True)) if len(text) else (mixed, mixed)
        return text[begins], first[begins], last[ends], hashes[begins], mixed[begins]


def _run_maker(bits, least: int, shards: int) -> Callable:
    """Runs of repeated hashes that are not crowded, packed by shard; strings of the mixed ones."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = _Kinds(bits)
        for batch in _together(batches):
            texts = batch["data"].tolist()
            text, first, last, hashes, mixed = kinds.runs(texts, least, False)
            if not len(text):
                continue
            order = np.argsort(hashes)  # shards are ranges of hashes
            text, first, last, hashes, mixed = (x[order] for x in (text, first, last, hashes, mixed))
            shard = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            doc, text_hash = (batch[name].to_numpy()[text] for name in ("doc", "text_hash"))
            begin = np.append(0, np.cumsum([len(data) for data in texts])[:-1])[text]
            counted = hashes >> np.uint64(64 - HASH_BITS)
            columns = (doc, text_hash, first - begin, last - first + 1, counted, mixed)
            frame = _packed(shard, dict(zip((*NUMBERS, "mixed"), columns, strict=True)), "shard", NUMBERS)
            whole = b"".join(texts)
            own = np.flatnonzero(mixed)
            strings = [whole[a:b] for a, b in zip(first[own].tolist(), (last[own] + least).tolist(), strict=True)]
            borders = np.searchsorted(own, np.append(_firsts(shard), len(shard))).tolist()
            frame["strings"] = [b"".join(strings[a:b]) for a, b in zip(borders[:-1], borders[1:], strict=True)]
            yield frame

    return run


def _crowded_runs(bits, least: int) -> Callable:
    """Runs of crowded hashes, each a row, the mixed ones with their strings."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = _Kinds(bits)
        for batch in _together(batches):
            texts = batch["data"].tolist()
            text, first, last, hashes, mixed = kinds.runs(texts, least, True)
            if not len(text):
                continue
            begin, whole = np.append(0, np.cumsum([len(data) for data in texts])[:-1])[text], b"".join(texts)
            rows = zip(mixed.tolist(), first.tolist(), (last + least).tolist(), strict=True)
            strings = [whole[a:b] if m else None for m, a, b in rows]
            doc, text_hash = (batch[name].to_numpy()[text] for name in ("doc", "text_hash"))
            place = {"start": first - begin, "end": last + least - begin}
            yield pd.DataFrame({"doc": doc, "text_hash": text_hash, **place, "hash": hashes.view(np.int64), "string": strings})

    return run


class _Shard:
    """The runs of a shard: the different strings, and where they occur."""

    def __init__(self, least: int, limit: int):
        self.least, self.limit, self.folder = least, limit, _spill_folder()
        self.file = SpooledTemporaryFile(max_size=limit, dir=self.folder)
        self.rows: list = []
        self.held = 0
        #: Of each different string: its hash, its windows, its smallest id.
        self.known: dict[tuple[int, bytes], int] = {}
        self.hashes: list[int] = []
        self.windows: list[int] = []
        self.firsts: list[int] = []
        self.mixed: list[tuple] = []
        self.equal: list[tuple] = []

    def add(self, row) -> None:
        self.rows.append(row)
        self.held += len(row.doc) + len(row.strings)
        if self.held > TOGETHER:
            self._take()

    def _take(self) -> None:
        own = {name: _from_planes([getattr(row, name) for row in self.rows], width) for name, width in NUMBERS.items()}
        mixed = np.frombuffer(b"".join(row.mixed for row in self.rows), bool)
        strings = b"".join(row.strings for row in self.rows)
        self.rows, self.held = [], 0
        columns = [own["hash"], *[own[name].view(np.int64) for name in ("doc", "text_hash", "start", "windows")]]
        self.equal.append(tuple(column[~mixed] for column in columns))
        hashes, doc, text_hash, start, windows = (column[mixed] for column in columns)
        which = np.empty(len(doc), np.int64)
        ends = np.cumsum(windows + self.least - 1).tolist()
        rows = zip(hashes.tolist(), doc.tolist(), windows.tolist(), [0, *ends], ends, strict=False)
        for i, (own_hash, own_doc, n, begin, end) in enumerate(rows):
            string = strings[begin:end]
            at = self.known.setdefault((own_hash, string), len(self.windows))
            if at == len(self.windows):
                self.hashes.append(own_hash)
                self.windows.append(n)
                self.firsts.append(own_doc)
                self.file.write(string)
            elif own_doc < self.firsts[at]:
                self.firsts[at] = own_doc
            which[i] = at
        self.mixed.append((which, doc, text_hash, start))

    def _strings(self, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """All written strings in pieces: the number of the first, their bytes, their lengths."""
        self.file.seek(0)
        pieces = np.append(_firsts(np.cumsum(lengths) // SEEN), len(lengths)).tolist()
        for a, b in zip(pieces[:-1], pieces[1:], strict=True):
            yield a, np.frombuffer(self.file.read(int(lengths[a:b].sum())), np.uint8), lengths[a:b]

    def _alike(self, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which strings may have a window in common with another one.

        Each has the ``KMER`` bytes of its hash, the smallest of all in it, and a window in common has them at one place.  Of the
        bytes beside them in a window two thirds are on the left, in the middle or on the right at least.  Strings
        with several smallest ones, and those of their hashes, count as alike.
        """
        beside = self.least - KMER
        step = beside // 3
        lefts, size = sorted({*range(0, beside - step, step or 1), beside - step}), self.least - step
        keys, owners, several = [], [], []
        for number, data, own in self._strings(lengths):
            ends = np.cumsum(own)
            starts = ends - own
            kmers = _kmer_hashes(data, KMER)
            kmers[(ends[:-1, None] - np.arange(1, KMER)).ravel()] = np.iinfo(np.uint64).max
            least = np.minimum.reduceat(kmers, starts)
            at = np.flatnonzero(kmers == np.repeat(least, own)[: len(kmers)])
            first = _firsts(np.searchsorted(ends, at, "right"))
            several.append(number + np.flatnonzero(np.diff(np.append(first, len(at))) > 1))
            wide, anchor = _kmer_hashes(data, size), at[first]
            for left in lefts:
                place = anchor - left
                fits = np.flatnonzero((place >= starts) & (place + size <= ends))
                keys.append(wide[place[fits]] + np.uint64(left))
                owners.append(number + fits)
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        found = np.isin(hashes, hashes[np.concatenate(several)])
        found[owners[order[np.append(same, False) | np.append(False, same)]]] = True
        return found

    def _text(self, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The chosen strings, characters from 1 up, each ended by 0."""
        text = array(int((lengths[chosen] + 1).sum()), "u2", self.limit, self.folder)
        at = 0
        for number, data, own in self._strings(lengths):
            picked = chosen[number : number + len(own)]
            data = data[np.repeat(picked, own)].astype(np.uint16) + 1
            data = np.insert(data, np.cumsum(own[picked]), 0)
            text[at : at + len(data)] = data
            at += len(data)
        return text

    def _least_ids(self, text: np.ndarray, begins: np.ndarray, windows: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """By place in the text, the smallest id of the documents with the window that begins there."""
        found = array(len(text), "i8", self.limit, self.folder)
        group, open_places, open_least = 0, [], NO_ID
        for pos, lcp, _ in suffixes(text, 257, self.limit, self.folder):
            groups = group + np.cumsum(lcp < self.least)
            string = np.searchsorted(begins, pos, "right") - 1
            own = np.flatnonzero(pos - begins[string] < windows[string])
            if groups[-1] != group and open_places and (not len(own) or groups[own[0]] != group):
                for places in open_places:
                    found[places] = open_least
                open_places, open_least = [], NO_ID
            if len(own):
                pos, ids, groups_of = pos[own], firsts[string[own]], groups[own]
                border = np.flatnonzero(np.append(True, groups_of[1:] != groups_of[:-1]))
                least = np.minimum.reduceat(ids, border)
                if groups_of[0] == group and open_places:
                    least[0] = min(least[0], open_least)
                    for places in open_places:
                        found[places] = least[0]
                found[pos] = np.repeat(least, np.diff(np.append(border, len(pos))))
                if groups_of[-1] == groups[-1]:  # the group may go on in the next piece
                    goes_on = len(border) == 1 and groups_of[0] == group
                    open_places = [*(open_places if goes_on else []), pos[border[-1] :]]
                    open_least = least[-1]
                else:
                    open_places, open_least = [], NO_ID
            group = int(groups[-1])
        return found

    def spans(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Where each occurrence repeats an earlier document: doc, hash of the text, start, end."""
        self._take()
        hashes, doc, text_hash, start, windows = (np.concatenate(x) for x in zip(*self.equal, strict=True))
        if len(doc):  # all strings of a hash are one
            order = np.argsort(hashes)
            begin = _firsts(hashes[order])
            first = np.empty(len(doc), np.int64)
            first[order] = np.repeat(np.minimum.reduceat(doc[order], begin), np.diff(np.append(begin, len(doc))))
            own = np.flatnonzero(first < doc)
            yield doc[own], text_hash[own], start[own], start[own] + windows[own] + self.least - 1
        if not self.windows:
            return
        windows, firsts = np.array(self.windows, np.int64), np.array(self.firsts, np.int64)
        self.known.clear()
        lengths = windows + self.least - 1
        alike = self._alike(lengths, np.array(self.hashes, np.uint64))
        sizes = np.where(alike, lengths + 1, 0)
        begins = np.cumsum(sizes) - sizes
        least = np.empty(0, np.int64)
        if alike.any():
            least = self._least_ids(self._text(lengths, alike), begins[alike], windows[alike], firsts[alike])
        for which, *columns in self.mixed:
            own = np.flatnonzero(~alike[which] & (firsts[which] < columns[0]))
            doc, text_hash, start = (column[own] for column in columns)
            yield doc, text_hash, start, start + lengths[which[own]]
            compared = np.flatnonzero(alike[which])
            pieces = np.cumsum(windows[which[compared]]) // COMPARED
            for own in np.split(compared, np.flatnonzero(np.diff(pieces)) + 1):
                yield self._repeated(least, which[own], begins, windows, *[column[own] for column in columns])

    def _repeated(self, least, which, begins, windows, doc, text_hash, start) -> tuple[np.ndarray, ...]:
        sizes = windows[which]
        row = np.repeat(np.arange(len(which)), sizes)
        window = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = least[begins[which][row] + window] < doc[row]
        follows = np.append(False, hit[:-1] & (row[1:] == row[:-1])) if len(row) else hit
        goes_on = np.append(hit[1:] & (row[1:] == row[:-1]), False) if len(row) else hit
        first, last = np.flatnonzero(hit & ~follows), np.flatnonzero(hit & ~goes_on)
        own = row[first]
        return doc[own], text_hash[own], start[own] + window[first], start[own] + window[last] + self.least


def _merged(doc: np.ndarray, text_hash: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans in the order of their texts, those that overlap or touch as one; ``text_hash`` has no sign."""
    order = np.lexsort((start, doc, text_hash))
    doc, text_hash, start, end = (x[order] for x in (doc, text_hash, start, end))
    new = np.append(True, (text_hash[1:] != text_hash[:-1]) | (doc[1:] != doc[:-1]))[: len(doc)]
    shift = np.cumsum(new) * (int(end.max(initial=0)) + 1)
    reached = np.maximum.accumulate(end + shift)
    first = np.flatnonzero(new | np.append(True, start[1:] + shift[1:] > reached[:-1])[: len(doc)])
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    return doc[first], text_hash[first], start[first], (reached - shift)[last]


def _pack_spans(spans: Iterable[tuple[np.ndarray, ...]], parts: int) -> Iterator[pd.DataFrame]:
    """Spans (doc, hash of the text, start, end) packed by the part that their text belongs to."""
    held, size = [], 0

    def packed() -> pd.DataFrame:
        doc, text_hash, start, end = (np.concatenate(x) for x in zip(*held, strict=True))
        doc, text_hash, start, end = _merged(doc, text_hash.view(np.uint64), start, end)
        part = ((text_hash >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        return _packed(part, {"doc": doc, "text_hash": text_hash, "start": start, "end": end}, "part", dict.fromkeys(SPAN, 8))

    for own in spans:
        if len(own[0]):
            held.append(own)
            size += len(own[0])
        if size > PACKED:
            yield packed()
            held, size = [], 0
    if held:
        yield packed()


def _sorter(least: int, limit: int, parts: int) -> Callable:
    """``batches`` come sorted by shard, so that one shard at a time is held."""

    def spans(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[np.ndarray, ...]]:
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        for _, own in groupby(rows, key=lambda row: row.shard):
            shard = _Shard(least, limit)
            for row in own:
                shard.add(row)
            yield from shard.spans()

    return lambda batches: _pack_spans(spans(batches), parts)


def _span_packer(parts: int) -> Callable:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _pack_spans((tuple(batch[name].to_numpy() for name in SPAN) for batch in batches), parts)

    return run


def _span_merger(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each text its spans as numbers, start and end in turn; ``batches`` come sorted by part."""
    rows = (row for batch in batches for row in batch.itertuples(index=False))
    for _, group in groupby(rows, key=lambda row: row.part):
        own = list(group)
        numbers = [_from_planes([getattr(row, name) for row in own], 8) for name in SPAN]
        doc, text_hash, start, end = _merged(*[x if name == "text_hash" else x.view(np.int64) for name, x in zip(SPAN, numbers, strict=True)])
        first = np.flatnonzero(np.append(True, (text_hash[1:] != text_hash[:-1]) | (doc[1:] != doc[:-1])))
        spans = np.stack((start, end), 1).astype("<i8")
        blobs = [spans[a:b].tobytes() for a, b in zip(first.tolist(), [*first[1:].tolist(), len(spans)], strict=True)]
        yield pd.DataFrame({"doc": doc[first], "text_hash": text_hash[first].view(np.int64), "spans": blobs})


def _hot_spans(runs: DataFrame, least: int) -> DataFrame:
    """(doc, text_hash, start, end) for runs of hot hashes: of mixed ones equal strings are put together first, then their windows are grouped."""
    equal, runs = runs.where("string IS NULL"), runs.where("string IS NOT NULL")
    earliest = small(written(equal.groupBy("hash").agg(F.min("doc").alias("least")), "hot-hashes"))
    whole = equal.join(earliest, "hash").where("least < doc").select(*SPAN)
    strings = written(runs.groupBy("hash", "string").agg(F.min("doc").alias("first")), "hot-strings")
    place = F.explode(F.sequence(F.lit(1), F.octet_length("string") - least + 1))
    windows = strings.withColumn("at", place).withColumn("window", F.substring("string", F.col("at"), F.lit(least)))
    firsts = written(windows.groupBy("window").agg(F.min("first").alias("least")), "hot-windows")
    ids = F.sort_array(F.collect_list(F.struct("at", "least")))
    known = windows.join(small(firsts), "window").groupBy("hash", "string").agg(ids.alias("ids"), F.max("least").alias("most"))
    known = small(written(known, "hot-ids"))
    hits = F.transform(F.filter("ids", lambda one: one["least"] < F.col("doc")), lambda one: F.struct(one["at"].alias("first"), one["at"].alias("last")))
    every = F.array(F.struct(F.lit(1).alias("first"), F.size("ids").alias("last")))
    found = runs.join(known, ["hash", "string"]).withColumn("hit", F.explode(F.when(F.col("most") < F.col("doc"), every).otherwise(hits)))
    begin, end = (F.col("start") + F.col(name) - 1 for name in ("hit.first", "hit.last"))
    return whole.unionByName(found.select("doc", "text_hash", begin.alias("start"), (end + least).alias("end")))


def repeated_spans(docs: DataFrame, least: int = LEAST, limit: int = IN_MEMORY, hot: int = HOT) -> DataFrame:
    """(doc, text_hash, spans): of each text the byte spans that repeat an earlier document, as numbers, start and end in turn.

    ``docs``: doc, text_hash, data.
    """
    spark = docs.sparkSession
    tasks = partitions(spark)
    bits = min(max((BUCKETS * tasks - 1).bit_length(), 1), FEWEST_BITS)
    counts = docs.select("data").mapInPandas(_hash_counter(least, bits), COUNTS)
    judged = written(counts.groupBy("bucket").applyInPandas(_judge(hot), KINDS), "repeated-hashes")
    hashes = judged.agg(F.sum(F.octet_length("kinds"))).first()[0] or 0
    kinds = _bits(judged, bits, hashes)
    known = spark.sparkContext.broadcast(kinds)
    runs = docs.mapInPandas(_run_maker(known, least, SHARDS * tasks), RUNS)
    shards = runs.repartition(tasks, "shard").sortWithinPartitions("shard")
    spans = shards.mapInPandas(_sorter(least, limit, tasks), PACKED_SPANS)
    if kinds[-1]:
        crowded = written(docs.mapInPandas(_crowded_runs(known, least), HOT_RUNS), "crowded-runs")
        spans = spans.unionByName(_hot_spans(crowded, least).mapInPandas(_span_packer(tasks), PACKED_SPANS))
    return spans.repartition(tasks, "part").sortWithinPartitions("part").mapInPandas(_span_merger, SPANS)


def _text_bits(spans: DataFrame) -> tuple[int, bytes]:
    """How many leading bits of a text's hash are looked up, and which are those of texts with spans."""
    texts, width = spans.count(), FEWEST_BITS
    while width < MOST_BITS and 1 << width < BITS_A_HASH * texts:
        width += 1
    place = F.shiftrightunsigned("text_hash", 64 - width)
    places = spans.select(place.alias("place")).distinct().withColumn("part", F.shiftright("place", FEWEST_BITS))

    def fill(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << FEWEST_BITS, bool)
        flags[own["place"].to_numpy() & ((1 << FEWEST_BITS) - 1)] = True
        return pd.DataFrame({"part": [key[0]], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    found = bytearray(1 << (width - 3))
    for row in places.groupBy("part").applyInPandas(fill, "part bigint, bits binary").toLocalIterator():
        at = row["part"] << (FEWEST_BITS - 3)
        found[at : at + len(row["bits"])] = row["bits"]
    return width, bytes(found)


def _has_bit(bits) -> Callable:
    @F.pandas_udf("boolean")
    def has_bit(text_hash: pd.Series) -> pd.Series:
        width, data = bits.value
        place = text_hash.to_numpy().view(np.uint64) >> np.uint64(64 - width)
        flags = np.frombuffer(data, np.uint8)[place >> np.uint64(3)]
        return pd.Series((flags >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1)

    return has_bit


def _cutter(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        cut, kept = [], []
        for data, spans in zip(batch["data"], batch["spans"], strict=True):
            numbers = [] if spans is None else np.frombuffer(spans, "<i8").tolist()
            borders = [0, *numbers, len(data)]
            kept.append(b"".join([data[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True)]))
            cut.append([{"start": a, "end": b} for a, b in zip(numbers[::2], numbers[1::2], strict=True)])
        yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["data"].map(len), "removed": cut, "kept": kept})


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, limit: int = IN_MEMORY, hot: int = HOT
) -> DataFrame:
    """doc_id, n_bytes, removed (maximal spans: start, end), kept (the bytes that are left): a row for each document.

    Spans go back by id and hash of the text: rows equal in both are equal in what they lose.  Which texts have spans is
    known from bits, too, so most others are not shuffled.
    """
    whole, own = F.coalesce(F.col(text), F.lit("")), F.col(key).cast("bigint")
    rows = docs.select(
        own.alias("doc_id"),
        F.coalesce(own, F.lit(NO_ID)).alias("doc"),
        F.xxhash64(whole).alias("text_hash"),
        whole.cast("binary").alias("data"),
    )
    merged = written(repeated_spans(rows.drop("doc_id"), least, limit, hot), "spans")
    bits = docs.sparkSession.sparkContext.broadcast(_text_bits(merged))
    marked = rows.withColumn("marked", _has_bit(bits)("text_hash"))
    cut = "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary"
    found = marked.where("marked").join(merged, ["doc", "text_hash"], "left").select("doc_id", "data", "spans")
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed")
    untouched = marked.where("NOT marked").select("doc_id", F.octet_length("data").cast("bigint").alias("n_bytes"), nothing, F.col("data").alias("kept"))
    return found.mapInPandas(_cutter, cut).unionByName(untouched)
