"""Importance resampling towards a target: documents whose word runs are more usual in the target are drawn more often.

An untrained pre-tokeniser splits the text, A to Z in lower case, and gives each word with its offsets.  Runs of one to
three words are windows over pairs of offsets; each falls into the bucket of its CRC-32.  The buckets of a document are
written once, as two bytes a run; histograms of all documents and of the target give each bucket a gain, and a document's
weight is the sum of its runs' gains.  With Gumbel noise from a hash of its key, the highest scores are a draw without
replacement.

Rows: a NULL or empty text, or one without a word, has no features and the weight 0.  A text of any length is read whole, in
pieces that end between words.  Rows that share a key have the same noise; ties go to the smaller key (NULL last), then
to fewer features, and equal rows are ranked one after the other.  A NULL key counts as empty text in the hash.  Without
documents of enough words, nothing is drawn; a target without rows leaves the gains to the documents alone.
"""

import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import numbered, written

BUCKETS = 10_000
MOST_WORDS = 3
LEAST_WORDS = 20
SHARE_PERCENT = 5
SEED = 42
#: What separates words: every ASCII character that is no digit and no lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_LOWER = {upper: upper + 32 for upper in range(65, 91)}
#: Characters that are split at once, and bytes of a word up to which its CRC is found together with others.
PIECE = 1 << 20
SHORT = 64
FEATURES = "doc_id bigint, n_words bigint, n_features bigint, buckets binary"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ (table & 1) * np.uint32(0xEDB88320)
    return table


def _longer_tables(table: np.ndarray) -> np.ndarray:
    """[n, k]: what the k-th byte of a CRC becomes when ``n`` bytes are put behind it."""
    found = np.empty((SHORT + 2, 4, 256), np.uint32)
    state = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(SHORT + 2):
        found[n] = state
        state = table[state & 255] ^ (state >> 8)
    return found


def word_spans(lowered: str, split) -> np.ndarray:
    """Offsets (first character, end) of all words; the text goes to the pre-tokeniser in pieces that end between words."""
    spans, begin, border = [], 0, re.compile(SEPARATORS)
    while begin < len(lowered):
        end = len(lowered)
        if end - begin > PIECE:
            found = border.search(lowered, begin + PIECE)
            end = found.end() if found else end
        offsets = [span for _, span in split.pre_tokenize_str(lowered[begin:end])]
        spans.append(np.array(offsets, np.int64).reshape(-1, 2) + begin)
        begin = end
    return np.concatenate(spans) if spans else np.empty((0, 2), np.int64)


class Featurizer:
    """Buckets of the word runs of texts; one per task."""

    def __init__(self, buckets: int = BUCKETS, most_words: int = MOST_WORDS):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(SEPARATORS), "removed")
        self.buckets, self.most_words = buckets, most_words
        self.table = _crc_table()
        self.longer = _longer_tables(self.table)

    def _crcs(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The CRC of each word: one byte of all words that are long enough at a time."""
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        state = np.full(len(start), 0xFFFFFFFF, np.uint32)
        for j in range(int(size[0]) if len(size) else 0):
            k = int(np.searchsorted(-size, -j))
            state[:k] = self.table[(state[:k] ^ data[start[:k] + j]) & 255] ^ (state[:k] >> 8)
        found = np.empty(len(start), np.uint32)
        found[order] = ~state
        return found

    def _behind(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What the CRC of a text adds to that of the text with ``size`` bytes behind it."""
        size = np.minimum(size, SHORT + 1)
        moved = self.longer[size, 0, crc & 255]
        for k in (1, 2, 3):
            moved ^= self.longer[size, k, (crc >> np.uint32(8 * k)) & 255]
        return moved

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(words, buckets of all runs) of each text."""
        import zlib

        blobs, starts, sizes, counts, at = [], [], [], [], 0
        for text in texts:
            lowered = text.translate(ASCII_LOWER)
            spans = word_spans(lowered, self.split)
            blob = np.frombuffer(lowered.encode("utf-8", "surrogatepass"), np.uint8)
            if len(blob) != len(lowered):  # offsets count characters
                spans = np.append(np.flatnonzero((blob & 0xC0) != 0x80), len(blob))[spans]
            blobs.append(blob)
            starts.append(spans[:, 0] + at)
            sizes.append(spans[:, 1] - spans[:, 0])
            counts.append(len(spans))
            at += len(blob)
        data, start, size = np.concatenate(blobs), np.concatenate(starts), np.concatenate(sizes)
        text_of = np.repeat(np.arange(len(texts)), counts)
        short = size <= SHORT
        crc = np.zeros(len(start), np.uint32)
        crc[short] = self._crcs(data, start[short], size[short])
        for i in np.flatnonzero(~short):
            crc[i] = zlib.crc32(data[start[i] : start[i] + size[i]])
        spaced = self._behind(np.full(len(crc), zlib.crc32(b" "), np.uint32), size) ^ crc  # of " word"
        runs, owners, run = [crc], [text_of], crc
        for k in range(1, self.most_words):
            n = max(len(start) - k, 0)
            run = self._behind(run[:n], size[k:] + 1) ^ spaced[k:]
            for i in np.flatnonzero(~short[k:]):  # continued byte by byte: no table is that long
                word = bytes(data[start[i + k] : start[i + k] + size[i + k]])
                run[i] = zlib.crc32(b" " + word, int(runs[-1][i]))
            runs.append(run)
            owners.append(np.where(text_of[:n] == text_of[k:], text_of[:n], -1))
        bucket = (np.concatenate(runs) % np.uint32(self.buckets)).astype("<u2")
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        borders = np.searchsorted(owner[order], np.arange(len(texts) + 1))
        for i, words in enumerate(counts):
            yield words, bucket[order[borders[i] : borders[i + 1]]]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Borders of consecutive texts that are worked on together: up to ``PIECE`` characters, or one text."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > PIECE:
            yield begin, i
            begin, held = i, 0
        held += len(text) + 1
    if held:
        yield begin, len(texts)


def _featurize(buckets: int, most_words: int) -> Callable:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        featurizer = Featurizer(buckets, most_words)
        for batch in batches:
            texts = batch["text"].tolist()
            for begin, end in _groups(texts):
                found = list(featurizer(texts[begin:end]))
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[begin:end],
                        "n_words": [words for words, _ in found],
                        "n_features": [len(own) for _, own in found],
                        "buckets": [own.tobytes() for _, own in found],
                    }
                )

    return run


def features(rows: DataFrame, key: str, text: str, buckets: int = BUCKETS, most_words: int = MOST_WORDS) -> DataFrame:
    """doc_id, n_words, n_features and the buckets of all word runs; written, so that texts are split once."""
    plain = rows.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return written(plain.mapInPandas(_featurize(buckets, most_words), FEATURES), "features")


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Runs in each bucket, over all rows: each task counts its own, and one row for each bucket comes back."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for blob in batch["buckets"]:
                total += np.bincount(np.frombuffer(blob, "<u2"), minlength=buckets)
        yield pd.DataFrame({"bucket": np.flatnonzero(total), "runs": total[total > 0]})

    parts = found.select("buckets").mapInPandas(count, "bucket bigint, runs bigint")
    total = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("runs").alias("runs")).toLocalIterator():
        total[row["bucket"]] = row["runs"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t+1)(S+n)/((s+1)(T+n))))`` of each bucket, ``n`` the number of buckets."""
    n = float(len(corpus))
    more, less = float(corpus.sum()) + n, float(target.sum()) + n
    found = [math.floor(1000 * math.log((t + 1.0) * more / ((s + 1.0) * less))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array(found, np.int64)


def _weigher(gain: np.ndarray) -> Callable:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weights = [int(gain[np.frombuffer(blob, "<u2")].sum()) for blob in batch["buckets"]]
            yield batch.drop(columns="buckets").assign(weight=np.array(weights, np.int64))

    return run


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_key: str = "item_id",
    target_text: str = "text",
    share_percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: a row for each document, ``rank`` from 1 where it is drawn.

    At most 65,536 buckets.
    """
    found = features(docs, key, text, buckets, most_words)
    gain = gains(histogram(found, buckets), histogram(features(target, target_key, target_text, buckets, most_words), buckets))
    weighed = found.mapInPandas(_weigher(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    noise = F.floor(-1000 * F.ln(-F.ln(uniform)))
    scored = written(weighed.withColumn("score", F.col("weight") + noise).withColumn("all", F.lit("")), "scored")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * share_percent // 100
    order = (F.when(enough, 0).otherwise(1), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"))
    ranked = numbered(scored, "all", *order)
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
