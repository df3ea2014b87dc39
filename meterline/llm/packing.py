"""Packing token sequences into windows of fixed length with bounded memory.

Each partition keeps ``OPEN`` windows.  A piece goes into the fullest window that it fits into; when none fits, the
fullest one is topped up with the beginning of the piece and emitted.  Windows still open at the end of a partition are
laid end to end over all partitions and cut again, so that the last sequence alone can be short.

Rows: a NULL or empty text is the end token alone; texts of any length are cut; repeated rows are packed each; a table
without rows gives none.
"""

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import written

LENGTH = 2048
OPEN = 16
END_TOKEN = 1
TOKENIZER = "byte_bpe_50k.json"
#: The same vocabulary as ranks, and the string that the tokenizer reads as one special token.
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
#: Sequences of merged leftovers are numbered from here, those of a partition from its number times 2^32.
MERGED = 1 << 61

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, part bigint, slot bigint, ids binary"
)


def encoder(tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> Callable[[str], np.ndarray]:
    """Token ids of a text as the tokenizer file gives them, without special tokens added.

    With ``ranks``, texts of Latin letters go through the faster reader of the same vocabulary; the ids are the same.  Any
    other text, and any that spells a special token, goes through the tokenizer itself.  Names are files of the installed
    collection of public tokenizers; a path with a slash is taken as it is.
    """
    import re

    import public_tokenizers
    from tokenizers import Tokenizer

    def place(name: str) -> str:
        return name if "/" in name else public_tokenizers.path(name)

    slow = Tokenizer.from_file(place(tokenizer))
    if ranks is None:
        return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")

    import base64

    import tiktoken

    with open(place(ranks), "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    unusual = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ſ]")

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text or unusual.search(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(fast.encode_ordinary(text), "<u4")

    return encode


class _Windows:
    """The open windows of one partition; ``done`` holds rows of full ones."""

    def __init__(self, part: int):
        self.part, self.number, self.done = part, part << 32, []
        self.left = [LENGTH] * OPEN
        self.held: list[list[tuple]] = [[] for _ in range(OPEN)]

    def place(self, doc, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while start < total:
            rest = total - start
            fitting = [left for left in self.left if left >= rest]
            at = self.left.index(min(fitting)) if fitting else self.left.index(min(self.left))
            length = min(rest, self.left[at])
            self.held[at].append((doc, start, ids[start : start + length], total))
            self.left[at] -= length
            start += length
            if not self.left[at]:
                self.emit(at)

    def emit(self, at: int) -> None:
        offset = 0
        for doc, start, ids, total in self.held[at]:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.number, offset, None, None, None))
            offset += len(ids)
        self.number += 1
        self.left[at], self.held[at] = LENGTH, []

    def leftovers(self) -> list[tuple]:
        pieces = [piece for held in self.held for piece in held]
        return [
            (doc, start, len(ids), None, total, None, None, self.part, slot, ids.tobytes())
            for slot, (doc, start, ids, total) in enumerate(pieces)
        ]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [field.split()[0] for field in PIECES.split(", ")]
    columns = dict(zip(names, zip(*rows, strict=True), strict=True))
    kinds = {name: object if name == "ids" else "Int64" for name in names}
    return pd.DataFrame({name: pd.array(list(columns[name]), dtype=kinds[name]) for name in names})


def _packer(tokenizer: str, ranks: str | None):
    def pack_partition(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, ranks)
        windows = _Windows(TaskContext.get().partitionId())
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encode(text), np.uint32(END_TOKEN)).astype("<u4")
                windows.place(None if pd.isna(doc) else int(doc), ids)
                if len(windows.done) >= 20_000:
                    yield _frame(windows.done)
                    windows.done = []
        rows = windows.done + windows.leftovers()
        if rows:
            yield _frame(rows)

    return pack_partition


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, ranks: str | None = RANKS
) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Pieces are written once, with the token ids of leftovers alone.  Leftovers are at most ``OPEN`` windows a partition;
    their places follow from the partitions' totals, one row each.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = written(rows.mapInPandas(_packer(tokenizer, ranks), PIECES), "pieces")
    packed = pieces.where("part IS NULL").drop("part", "slot", "ids")
    left = pieces.where("part IS NOT NULL")
    totals = left.groupBy("part").agg(F.sum("length").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = left.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(starts, "part")
    placed = placed.withColumn("at", F.col("base") + F.col("inside"))
    first, last = F.expr("at DIV 2048"), F.expr("(at + length - 1) DIV 2048")
    cut = placed.withColumn("window", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("at"), F.col("window") * LENGTH)
    end = F.least(F.col("at") + F.col("length"), (F.col("window") + 1) * LENGTH)
    cut = cut.withColumns({"skip": (begin - F.col("at")).cast("int"), "size": (end - begin).cast("int"), "begin": begin})
    merged = cut.select(
        "doc_id",
        (F.col("start") + F.col("skip")).alias("start"),
        F.col("size").cast("bigint").alias("length"),
        F.crc32(F.col("ids").substr(F.col("skip") * 4 + 1, F.col("size") * 4)).alias("ids_crc32"),
        "doc_tokens",
        (F.col("window") + F.lit(MERGED)).alias("sequence_id"),
        (F.col("begin") - F.col("window") * LENGTH).alias("offset"),
    )
    return packed.unionByName(merged)
