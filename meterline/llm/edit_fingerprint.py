"""Fingerprints under which a small edit distance becomes a small Hamming distance.

A pointer walks over the characters of a text.  At every step the character under it is emitted, and a random bit of
(step, character), the same for all texts, says whether the pointer moves on.  Two walks that meet stay together while
the texts agree, and after an edit they meet again soon, so that the emitted sequences differ in few places.  A
fingerprint samples ``SLOTS`` steps of a walk and keeps one random bit of what each of them emitted.

One unlucky meeting can keep two walks apart for long, so there are ``WALKS`` independent walks, each with its own share of
the slots, and the likeness of two fingerprints is that of the walk in which they agree most.

Texts differ in length, so the steps are sampled consistently: slot ``k`` takes the step with the smallest random rank
among all steps of the walk.  For walks of ``a <= b`` steps, a fraction ``a / b`` of the slots takes the same steps.
Emitted is the character with the ``CONTEXT - 1`` that follow it; single letters would agree by chance too often.

Rows: NULL text counts as empty; the empty text has the fingerprint of all zeros; equal texts have equal fingerprints;
any text is walked to its end.  Repeated rows are kept.
"""

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import partitions, written
from meterline.llm.components import components

WALKS = 2
SLOTS = 512
CONTEXT = 4
SEED = 20_240
#: Characters walked at a time; bounds the memory of a task.
BATCH_CHARS = 6_000_000
BANDS = 128
BAND_BITS = 20
LARGE_GROUP = 64
FURTHER_CUTS = 16

_END = 255
_BLOCK = 4096


@lru_cache(maxsize=4)
def _moves(walk: int, block: int) -> np.ndarray:
    """Random bits for ``_BLOCK`` steps and 256 classes of characters; nothing moves beyond the end of a text."""
    drawn = np.random.RandomState([SEED, walk, block]).bytes(_BLOCK * 256 // 8)
    bits = np.unpackbits(np.frombuffer(drawn, np.uint8)).reshape(_BLOCK, 256).copy()
    bits[:, _END] = 0
    return bits


class _Sampled:
    """Steps at which a slot finds a smaller rank than before: ``at[step]`` lists those slots.

    Given a record at step ``r``, the next one comes after step ``t`` with probability ``(r + 1) / (t + 1)``, so the
    records are drawn directly, as far as a walk goes.
    """

    def __init__(self, walk: int):
        self.at: dict[int, list[int]] = {0: list(range(SLOTS))}
        self.last = np.zeros(SLOTS, np.int64)
        self.random = [np.random.RandomState([SEED, 7, walk, slot]) for slot in range(SLOTS)]
        self.known = 0

    def up_to(self, step: int) -> None:
        if step <= self.known:
            return
        for slot in range(SLOTS):
            while self.last[slot] <= step:
                draw = 1.0 - self.random[slot].random_sample()
                self.last[slot] = int((self.last[slot] + 1) / draw)
                self.at.setdefault(int(self.last[slot]), []).append(slot)
        self.known = step


@lru_cache(maxsize=WALKS)
def _sampled(walk: int) -> _Sampled:
    return _Sampled(walk)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    values = (values ^ (values >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return values ^ (values >> np.uint32(16))


def _walk(texts: list[str]) -> np.ndarray:
    """Bits of all texts, one row of ``WALKS * SLOTS`` bits each."""
    bits = np.zeros((WALKS * SLOTS, len(texts)), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    width = lengths + CONTEXT
    starts = np.concatenate([[0], np.cumsum(width)[:-1]])
    flat = np.full(int(width.sum()) + CONTEXT, 0x110000, np.uint32)
    for text, start in zip(texts, starts, strict=True):
        flat[start : start + len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = ((flat * np.uint32(0x9E3779B1)) >> np.uint32(20)) % np.uint32(_END)
    classes = np.where(flat == 0x110000, _END, classes).astype(np.uint8)
    emitted = flat * np.uint32(0x01000193)
    size = len(flat) - CONTEXT
    for offset in range(1, CONTEXT):
        emitted[:size] = (emitted[:size] + flat[offset : offset + size]) * np.uint32(0x01000193 + 2 * offset)
    emitted = _mix(emitted)

    for walk in range(WALKS):
        sampled = _sampled(walk)
        walking = np.flatnonzero(lengths)
        place = starts[walking]
        step = 0
        while len(walking):
            if step % 64 == 0:
                going = classes[place] != _END
                if not going.all():
                    walking, place = walking[going], place[going]
                    if not len(walking):
                        break
                here = np.empty(len(walking), np.uint8)
                move = np.empty(len(walking), np.uint8)
            if step % _BLOCK == 0:
                moves = _moves(walk, step // _BLOCK)
                sampled.up_to(step + _BLOCK)
            np.take(classes, place, out=here, mode="clip")
            if step in sampled.at:
                inside = here != _END
                columns, found = walking[inside], emitted[place[inside]]
                for slot in sampled.at[step]:
                    key = np.uint32((slot * 0x9E3779B1 + step * 0x85EBCA77) & 0xFFFFFFFF)
                    bits[walk * SLOTS + slot, columns] = _mix(found ^ key) >> np.uint32(31)
            np.take(moves[step % _BLOCK], here, out=move, mode="clip")
            place += move
            step += 1
    return np.ascontiguousarray(bits.T)


def fingerprint_bits(texts: list[str]) -> np.ndarray:
    """Packed fingerprints, ``WALKS * SLOTS / 8`` bytes a text.  Texts of like length walk together."""
    packed = np.zeros((len(texts), WALKS * SLOTS // 8), np.uint8)
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    at = 0
    while at < len(order):
        chars, end = 0, at
        while end < len(order) and (end == at or chars + len(texts[order[end]]) <= BATCH_CHARS):
            chars += len(texts[order[end]])
            end += 1
        chosen = order[at:end]
        packed[chosen] = np.packbits(_walk([texts[i] for i in chosen]), axis=1)
        at = end
    return packed


def likeness_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """1 for equal fingerprints, about 0 for those of unrelated texts, where half of the bits agree by chance."""
    differing = np.bitwise_count(left ^ right).reshape(len(left), WALKS, SLOTS // 8).sum(axis=2).min(axis=1)
    return np.clip(1.0 - 2.0 * differing / SLOTS, 0.0, 1.0)


def edit_fingerprints(text: Column) -> Column:
    """The fingerprint of a text as lowercase hex."""

    @F.pandas_udf("string")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes().hex() for row in fingerprint_bits(texts.fillna("").tolist())], dtype=object)

    return fingerprint(text)


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first characters of ``following``, or by all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(docs: DataFrame, key: str, value: str) -> DataFrame:
    """Rows (part, is_next, key, value), where within a part each row is followed by the next row of the whole table.

    The key's quantiles cut the table into as many parts as there are shuffle partitions.  The first row of a part is
    also given to the part before it, and the very first to the last, as a row with ``is_next``.  Order: key, NULL first,
    then value.  Each text moves once; the driver sees one key a part.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), F.coalesce(F.col(value), F.lit("")).alias("value"))
    cuts = docs.select("key").approxQuantile("key", [i / partitions(spark) for i in range(1, partitions(spark))], 0.001)
    bounds = F.array(*[F.lit(int(cut)) for cut in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda bound: bound <= F.col("key")))
    parted = docs.withColumn("part", part)
    found = parted.groupBy("part").agg(F.min("key").alias("first"), F.max(F.col("key").isNull()).alias("null")).collect()
    if not found:
        return parted.select("part", F.lit(False).alias("is_next"), "key", "value")
    firsts = sorted((row["part"], row["first"]) for row in found)
    before = {first: previous for (previous, _), (_, first) in zip(firsts, firsts[1:], strict=False)}
    smallest = None if any(row["null"] for row in found) else firsts[0][1]
    wrapped = (
        docs.where(F.col("key").eqNullSafe(F.lit(smallest).cast("bigint")))
        .orderBy("value")
        .limit(1)
        .select(F.lit(firsts[-1][0]).alias("part"), F.lit(True).alias("is_next"), "key", "value")
    )
    starts = F.array(*[F.lit(first) for first in before]) if before else F.array().cast("array<bigint>")
    targets = F.array(*[F.lit(previous) for previous in before.values()]) if before else F.array().cast("array<int>")
    position = F.array_position(starts, F.coalesce(F.col("key"), F.lit(0)))
    first_of_part = F.when(F.col("key").isNotNull() & (position > 0), F.get(targets, (position - 1).cast("int")))
    own = F.struct(F.col("part"), F.lit(False).alias("is_next"))
    given = F.struct(first_of_part.alias("part"), F.lit(True).alias("is_next"))
    copies = F.explode(F.when(first_of_part.isNull(), F.array(own)).otherwise(F.array(own, given)))
    rows = parted.select(copies.alias("copy"), "key", "value").select("copy.part", "copy.is_next", "key", "value")
    return (
        rows.unionByName(wrapped)
        .repartitionByRange(partitions(spark), "part")
        .sortWithinPartitions("part", "is_next", F.asc_nulls_first("key"), "value")
    )


def _pairs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprints of consecutive rows; the last row of a batch waits for the first of the next."""
    waiting: list[tuple] = []
    for batch in batches:
        rows = waiting + list(batch[["part", "is_next", "key", "value"]].itertuples(index=False, name=None))
        waiting = rows[-1:]
        at = 0
        while at < len(rows) - 1:
            chars, end = 0, at
            while end < len(rows) - 1 and (end == at or chars < 4 * BATCH_CHARS):
                chars += 2 * len(rows[end][3])
                end += 1
            yield _fingerprinted(rows[at : end + 1])
            at = end
    # A part ends with the row that follows it, so nothing is left but that row.


def _fingerprinted(rows: list[tuple]) -> pd.DataFrame:
    texts = [row[3] for row in rows]
    own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    edited = [edited_text(texts[i], texts[i + 1]) for i in own]
    bits = fingerprint_bits(texts + edited)
    mine, changed, following = bits[own], bits[len(texts) :], bits[[i + 1 for i in own]]
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if pd.isna(rows[i][2]) else int(rows[i][2]) for i in own], dtype="Int64"),
            "n_chars": pd.Series([len(texts[i]) for i in own], dtype="int64"),
            "edited_sha256": pd.Series([hashlib.sha256(t.encode()).hexdigest() for t in edited], dtype=object),
            "fingerprint": pd.Series([row.tobytes().hex() for row in mine], dtype=object),
            "edited_fingerprint": pd.Series([row.tobytes().hex() for row in changed], dtype=object),
            "near_edited": likeness_of(mine, changed),
            "near_next": likeness_of(mine, following),
        }
    )


PAIR_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def neighbour_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's fingerprint, that of its text half replaced by the next one, and its likeness to both.

    The next row is the one with the next larger key, after the last the first.  A table of one row is followed by itself.
    """
    return with_following(docs, key, text).mapInPandas(_pairs, PAIR_SCHEMA)


# ---------------------------------------------------------------------------------------------------------------------
# Near-duplicates: bit-sampled bands, then verification by the edit distance itself.


def edit_distance(left: str, right: str) -> int:
    """Levenshtein distance, 64 and more cells at a time as the bits of one integer."""
    if len(left) > len(right):
        left, right = right, left
    if not left:
        return len(right)
    where: dict[str, int] = {}
    for i, char in enumerate(left):
        where[char] = where.get(char, 0) | 1 << i
    mask, top = (1 << len(left)) - 1, 1 << (len(left) - 1)
    rising, falling, distance = mask, 0, len(left)
    for char in right:
        match = where.get(char, 0)
        diagonal = (((match & rising) + rising) ^ rising) | match | falling
        up, down = falling | ~(diagonal | rising) & mask, rising & diagonal
        distance += bool(up & top) - bool(down & top)
        up = up << 1 | 1
        rising = (down << 1 | ~(diagonal | up)) & mask
        falling = up & diagonal & mask
    return distance


def _band_keys(hexed: pd.Series) -> list[list[int]]:
    slots = np.random.RandomState(SEED + 1).randint(0, SLOTS, (BANDS, BAND_BITS))
    slots += SLOTS * (np.arange(BANDS) % WALKS)[:, None]
    keys = []
    for value in hexed:
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(value), np.uint8)).astype(np.int64)
        keys.append(((np.arange(BANDS) << BAND_BITS) + bits[slots] @ (1 << np.arange(BAND_BITS))).tolist())
    return keys


def _further_keys(hexed: pd.Series) -> list[list[int]]:
    """``FURTHER_CUTS`` numbers of ``BAND_BITS`` bits each, sampled from all walks."""
    slots = np.random.RandomState(SEED + 2).randint(0, WALKS * SLOTS, (FURTHER_CUTS, BAND_BITS))
    keys = []
    for value in hexed:
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(value), np.uint8)).astype(np.int64)
        keys.append(((np.arange(FURTHER_CUTS) << BAND_BITS) + bits[slots] @ (1 << np.arange(BAND_BITS))).tolist())
    return keys


def _by_size(keyed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of groups of two to ``LARGE_GROUP`` rows, and those of larger groups."""
    sizes = written(keyed.groupBy(key).agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "edit-sizes")
    few = keyed.join(sizes.where(F.col("size") <= LARGE_GROUP).select(key), key, "left_semi")
    return few, keyed.join(sizes.where(F.col("size") > LARGE_GROUP).select(key), key, "left_semi")


def _all_pairs(keyed: DataFrame) -> DataFrame:
    one, other = keyed.select("band", "node"), keyed.select("band", F.col("node").alias("other"))
    return one.join(other, "band").where("node > other").select("node", "other")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """(key, fingerprint, component): documents linked by an edit distance of at most ``1 - similarity`` of the longer text.

    Equal texts are one node.  Each of ``BANDS`` bands groups nodes by ``BAND_BITS`` bits sampled from one walk.  In a group
    of up to ``LARGE_GROUP`` nodes all are compared.  A larger group is cut again, by as many further bits of the other
    walks for each of ``FURTHER_CUTS`` draws; in what is still larger, a node is compared with the smallest node and its
    predecessor, so that candidates grow with the number of nodes, not with its square.  A candidate counts only if the
    edit distance confirms it.  ``component`` is the smallest key reachable.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(F.col(key).alias("key"), F.sha2(whole, 256).alias("node"), whole.alias("whole")), "edit-rows"
    )
    nodes = rows.groupBy("node").agg(F.min("key").alias("first"), F.any_value("whole").alias("whole"))
    nodes = written(nodes.withColumn("fingerprint", edit_fingerprints(F.col("whole"))), "edit-nodes")

    @F.pandas_udf("array<long>")
    def bands(hexed: pd.Series) -> pd.Series:
        return pd.Series(_band_keys(hexed))

    @F.pandas_udf("array<long>")
    def cuts(hexed: pd.Series) -> pd.Series:
        return pd.Series(_further_keys(hexed))

    banded = nodes.select("node", "fingerprint", F.explode(bands("fingerprint")).alias("band"))
    few, large = _by_size(written(banded, "edit-bands"), "band")
    further = large.withColumn("cut", F.explode(cuts("fingerprint"))).withColumn("band", F.xxhash64("band", "cut"))
    few_further, crowded = _by_size(written(further.drop("cut"), "edit-cuts"), "band")
    ordered = Window.partitionBy("band").orderBy("fingerprint", "node")
    beside = crowded.select("node", F.array(F.first("node").over(ordered), F.lag("node").over(ordered)).alias("others"))
    chained = beside.select("node", F.explode("others").alias("other")).where("other <> node")
    pairs = _all_pairs(few).unionByName(_all_pairs(few_further)).unionByName(chained)
    pairs = pairs.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")).distinct()
    left = nodes.select("node", F.col("whole").alias("left"))
    right = nodes.select(F.col("node").alias("other"), F.col("whole").alias("right"))

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        def close(x: str, y: str) -> bool:
            longest = max(len(x), len(y))
            least = abs(len(x) - len(y))
            return least <= (1 - similarity) * longest and edit_distance(x, y) <= (1 - similarity) * longest

        return pd.Series([close(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    links = pairs.join(left, "node").join(right, "other").where(near("left", "right")).select("node", "other")
    classes = written(components(links, "node", "other"), "edit-classes")
    rooted = nodes.join(classes, "node", "left").select(
        "node", "fingerprint", "first", F.coalesce("root", "node").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = written(rooted.join(smallest, "root").select("node", "fingerprint", "component"), "edit-components")
    return rows.join(named, "node").select(F.col("key").alias(key), "fingerprint", "component")
