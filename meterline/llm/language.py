"""Language of a text by compression: the language whose dictionary makes the text smallest.

Each language gives a raw-content dictionary for zstandard.  A text is reduced to its lower-case letters, cut into pieces
of ``PIECE_CHARS`` so that a long text cannot serve as its own dictionary, and compressed whole with each dictionary.
``score`` is the softmax of the sizes in units of ``UNIT_BYTES``; a prediction whose margin over the second language is
narrow is marked ``rejected``.

The dictionaries are fitted to a bounded sample: per language at most ``SAMPLE_DOCS`` different training texts, those with the
smallest hashes, and a piece of each, ``DICTIONARY_BYTES`` together.  Everything else covers all rows.

Rows: a text that is NULL or has no letter is ``und`` with score 0 and rejected; so is any text if nothing was learned;
languages equal in size are decided by their number of training texts, then by name; repeated rows are predicted each.
"""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import bucket, smallest_hashes_by, written

SAMPLE_DOCS = 400
DICTIONARY_BYTES = 120_000
#: Characters of a sampled text that are used at least; with few texts it is their share of the dictionary.
LEAST_PIECE = 300
LEVEL = 6
PIECE_CHARS = 4_000
UNIT_BYTES = 4.0
#: Narrower margins, in bytes and as a share of the size, are rejected.
MARGIN_BYTES = 3
MARGIN_SHARE = 0.01
FOLDS = 5
UNKNOWN = "und"

_other = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return _other.sub(" ", text.lower()).strip()


def dictionaries(docs: DataFrame, key: str, text: str, lang: str) -> dict[str, bytes]:
    """Dictionary content by language, from training rows only; the language with most training texts first."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where((bucket(F.col("key"), FOLDS) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = written(smallest_hashes_by(rows, "lang", SAMPLE_DOCS, "key", "text"), "sample")
    texts = {row["group"]: row["count"] for row in sample.groupBy("group").count().collect()}
    # As much of each text as its share of the dictionary, from a place that its hash gives; of a short text all.
    size = F.lit(LEAST_PIECE)
    for name, n in texts.items():
        size = F.when(F.col("group") == name, max(LEAST_PIECE, -(-DICTIONARY_BYTES // n))).otherwise(size)
    room = F.greatest(F.length("text") - size, F.lit(0)) + 1
    piece = F.substring("text", F.pmod(F.col("hash"), room).cast("int") + 1, size)
    found: dict[str, list[tuple[int, str]]] = {}
    for row in sample.select("group", "hash", piece.alias("text")).collect():
        found.setdefault(row["group"], []).append((row["hash"], row["text"]))
    content = {}
    for name, own in sorted(found.items(), key=lambda item: (-sizes[item[0]], item[0])):
        joined = " ".join(letters(text) for _, text in sorted(own)).encode()
        content[name] = joined[:DICTIONARY_BYTES]
    return {name: joined for name, joined in content.items() if len(joined) >= 8}


class Compressors:
    def __init__(self, content: dict[str, bytes]):
        self.languages = list(content)
        self.each = []
        for joined in content.values():
            data = zstandard.ZstdCompressionDict(joined, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL,
                source_size=PIECE_CHARS,
                dict_size=len(joined),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            data.precompute_compress(compression_params=settings)
            self.each.append(zstandard.ZstdCompressor(dict_data=data, compression_params=settings))

    def sizes(self, text: str) -> np.ndarray:
        """Compressed bytes of the whole text with each dictionary."""
        total = np.zeros(len(self.each), np.int64)
        for at in range(0, len(text), PIECE_CHARS):
            piece = text[at : at + PIECE_CHARS].encode("utf-8", "surrogatepass")
            total += [len(one.compress(piece)) for one in self.each]
        return total

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        plain = letters(text) if text else ""
        # Other signs that count as parts of words, such as fractions and superscripts, are no letters.
        if not any(map(str.isalpha, plain)) or not self.each:
            return UNKNOWN, 0.0, True
        sizes = self.sizes(plain)
        best = int(sizes.argmin())
        score = 1.0 / np.exp(np.maximum(sizes[best] - sizes, -2800) / UNIT_BYTES).sum()
        if len(sizes) == 1:
            return self.languages[best], float(score), False
        margin = int(np.partition(sizes, 1)[1] - sizes[best])
        narrow = margin < MARGIN_BYTES or margin < MARGIN_SHARE * sizes[best]
        return self.languages[best], float(score), narrow


def predict_language(docs: DataFrame, content: dict[str, bytes], key: str, text: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def predict(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressors = Compressors(shared.value)
        for batch in batches:
            found = [compressors.predict(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "held_out": batch["held_out"],
                    "lang_pred": [name for name, _, _ in found],
                    "score": [score for _, score, _ in found],
                    "rejected": [narrow for _, _, narrow in found],
                }
            )

    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), (bucket(F.col(key), FOLDS) == 0).alias("held_out"), F.col(text).alias("text")
    )
    return rows.mapInPandas(predict, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")
