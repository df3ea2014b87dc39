"""SimHash fingerprints of word shingles, linked by Golay-coded segments.

A fingerprint of 64 bits is cut into three segments.  If two fingerprints differ in at most two bits, then for one of
the segments they agree exactly while the segment after it (the first comes after the last) differs in at most one bit:
if both differences fall into one segment, take the one after it; else the third segment is clean and any other differs
once at most.  So each fingerprint is filed under (exact segment, code word near the next segment), and the fingerprints
of one file are compared.

Equal fingerprints are one node.  A file with more than ``LARGE_FILE`` fingerprints is not compared pair by pair: its
fingerprints are filed once more under each of the 65 words within one bit of them.  Two fingerprints differ in at most
two bits exactly if they share such a word, so all that share one are linked to the smallest.  No link is lost, and
links grow with the number of fingerprints, not with the square of a file.

Rows: NULL text counts as empty; texts without words have fingerprint 0 and link like others; repeated rows and equal
keys are kept; a class whose keys are all NULL has the component NULL.
"""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm import golay
from meterline.llm.common import WORD, written
from meterline.llm.components import components

SHINGLE_WORDS = 3
HASH_SEED = 42
MOST_BITS = 2
LARGE_FILE = 64
#: First bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Shingle hashes turned into counters at a time.
BATCH_SHINGLES = 400_000

_lower = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
_word = re.compile(WORD)


def _shingle_hashes(text: str, width: int) -> list[int]:
    found = _word.findall(text.translate(_lower) if not text.isascii() else text.lower())
    if len(found) > width:
        return [
            xxhash.xxh64_intdigest(" ".join(found[i : i + width]), HASH_SEED) for i in range(len(found) - width + 1)
        ]
    return [xxhash.xxh64_intdigest(" ".join(found), HASH_SEED)] if found else []


def fingerprints(texts: list[str], width: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned 64-bit fingerprints; a bit is set if more than half of the shingle hashes have it."""
    result = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)

    def settle(hashes: list[int], owners: list[int], starts: list[int]) -> None:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        sizes = np.diff([*starts, len(hashes)])
        for i, value in zip(owners, ((2 * counts > sizes[:, None]) * weights).sum(axis=1, dtype=np.uint64), strict=True):
            result[i] = value

    def settle_long(hashes: list[int], owner: int) -> None:
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), BATCH_SHINGLES):
            part = np.array(hashes[at : at + BATCH_SHINGLES], "<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        result[owner] = ((2 * counts > len(hashes)) * weights).sum(dtype=np.uint64)

    hashes, owners, starts = [], [], []
    for i, text in enumerate(texts):
        own = _shingle_hashes(text, width)
        if len(own) > BATCH_SHINGLES:
            settle_long(own, i)
        elif own:
            owners.append(i)
            starts.append(len(hashes))
            hashes += own
        if len(hashes) >= BATCH_SHINGLES:
            settle(hashes, owners, starts)
            hashes, owners, starts = [], [], []
    if hashes:
        settle(hashes, owners, starts)
    return result


def simhash(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text as bigint with the same 64 bits."""

    @F.pandas_udf("bigint")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts.fillna("").tolist(), width).view(np.int64))

    return fingerprint(text)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _filed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each fingerprint under (segment, its exact bits, a code word near the next segment), packed into one number."""
    for batch in batches:
        prints = batch["fingerprint"].to_numpy(np.int64).view(np.uint64)
        parts = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
        for i, exact in enumerate(parts):
            position, near = golay.keys(parts[(i + 1) % len(parts)])
            file = (np.int64(i) << 40) | (exact[position] << 12) | near
            yield pd.DataFrame({"file": file, "fingerprint": batch["fingerprint"].to_numpy()[position]})


def _within_one_bit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    masks = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for batch in batches:
        prints = batch["fingerprint"].to_numpy(np.int64)
        for at in range(0, len(prints), 20_000):
            part = prints[at : at + 20_000]
            near = (part.view(np.uint64)[:, None] ^ masks[None, :]).view(np.int64)
            yield pd.DataFrame({"file": near.ravel(), "fingerprint": np.repeat(part, len(masks))})


def links(nodes: DataFrame) -> DataFrame:
    """(node, other): links that connect all fingerprints which differ in at most two bits, directly or in steps.

    ``nodes`` has distinct values in ``fingerprint``.
    """
    schema = "file bigint, fingerprint bigint"
    files = written(nodes.select("fingerprint").mapInPandas(_filed, schema), "files")
    sizes = files.groupBy("file").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = written(sizes, "file-sizes")
    few = files.join(sizes.where(F.col("size") <= LARGE_FILE), "file").select("file", "fingerprint")
    one, other = few.select("file", F.col("fingerprint").alias("node")), few.withColumnRenamed("fingerprint", "other")
    compared = (
        one.join(other, "file")
        .where(F.col("node") > F.col("other"))
        .where(F.bit_count(F.col("node").bitwiseXOR(F.col("other"))) <= MOST_BITS)
    )
    large = files.join(sizes.where(F.col("size") > LARGE_FILE), "file", "left_semi").select("fingerprint").distinct()
    shared = large.mapInPandas(_within_one_bit, schema)
    smallest = Window.partitionBy("file")
    starred = shared.select(F.col("fingerprint").alias("node"), F.min("fingerprint").over(smallest).alias("other"))
    return compared.select("node", "other").unionByName(starred.where("node <> other")).distinct()


def simhash_classes(prints: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """(key, fingerprint, component_id) for each row; ``component_id`` is the smallest key reachable over links.

    ``prints`` should be a written table: it is read twice.  Keys may be of any type with an order.
    """
    rows = prints.select(F.col(key).alias("key"), F.col(fingerprint).alias("fingerprint"))
    nodes = written(rows.groupBy("fingerprint").agg(F.min("key").alias("first")), "prints")
    roots = written(components(links(nodes), "node", "other"), "roots")
    rooted = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.join(smallest, "root").select("fingerprint", "component_id"), "named")
    return rows.join(named, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")
