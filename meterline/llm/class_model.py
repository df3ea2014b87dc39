"""Class-based bigrams: words fall into classes, and a text's probability is that of its classes and of words given them.

``P(word | previous word) = P(class | previous class) P(item | class) P(word | item)``.  An item is a frequent word, the
group of all rarer words with the same last three bytes where that group is frequent, the group of all other words, or
the end of a text.  Items are frequent by definition, so there are at most ``2 ITEMS + 2`` of them, however large the
vocabulary; every word, seen or not, belongs to one.  Exchange clustering puts the items into ``CLASSES`` classes: each
round moves items to the class that raises the likelihood of the class bigrams most.

What is gathered from the corpus: the count of every word, and the count of every pair of neighbouring items.  The most
frequent words (each at least one in ``HEAD`` tokens, hence at most ``HEAD``) are sent to all tasks; counts of all others
are joined.

Tokens: A to Z in lower case, words, one end.  Rows: NULL text counts as empty and consists of the end alone; repeated rows
are scored each; without training rows every token has the probability that an empty table of counts gives.
"""

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import bucket, written

FOLDS = 10
HEAD = 500_000
ITEMS = 10_000
CLASSES = 64
ROUNDS = 5
#: Added to every count, as in the base score.
ADDED = 0.1
#: Weight of the class frequencies against the bigrams of a class, in tokens.
SMOOTHING = 20.0
END = b""
_OTHER = 0


def tokens(text: str) -> list[bytes]:
    """The words of a text, A to Z in lower case.  Bytes are split at just the white space that separates words."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _is_training(key: Column) -> Column:
    return bucket(key, FOLDS) != 0


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c) for every distinct token of the column ``text``; the end is the empty word."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(tokens(text))
            counts[END] += len(batch)
            if len(counts) > 400_000:
                yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})
                counts = Counter()
        yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})

    found = training.select("text").mapInPandas(count, "word binary, c bigint").where("c > 0")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Items and head words.  Item 0 holds the words of no other item, item 1 is the end."""

    total: int
    distinct: int
    words: dict[bytes, int]
    word_items: np.ndarray
    word_counts: np.ndarray
    endings: dict[bytes, int]
    item_counts: np.ndarray
    item_words: np.ndarray
    single: np.ndarray

    def items(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the head word or -1, item) for each word."""
        get, ending = self.words.get, self.endings.get
        heads = np.array([get(word, -1) for word in found], np.int64)
        items = self.word_items[heads] if len(self.word_items) else np.zeros(len(found), np.int64)
        for at in np.flatnonzero(heads < 0).tolist():
            items[at] = ending(found[at][-3:], _OTHER)
        return heads, items


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the written table of counts; at most ``HEAD`` words and ``ITEMS`` endings come to the driver."""
    sums = counts.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    total, distinct = sums["total"] or 0, sums["distinct"]
    head = counts.where((F.col("c") * HEAD >= total) & (F.length("word") > 0)).orderBy(F.desc("c"), "word").collect()
    ends = counts.where(F.length("word") == 0).collect()
    rare = counts.where((F.col("c") * ITEMS < total) & (F.length("word") > 0))
    ending = F.expr("substring(word, greatest(length(word) - 2, 1), 3)").alias("ending")
    groups = rare.groupBy(ending).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("words"))
    groups = groups.where(F.col("c") * ITEMS >= total).orderBy(F.desc("c"), "ending").collect()
    rest = rare.agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("words")).first()
    item_counts = [(rest["c"] or 0) - sum(g["c"] for g in groups), ends[0]["c"] if ends else 0]
    item_words = [rest["words"] - sum(g["words"] for g in groups), 1]
    endings = {}
    for row in groups:
        endings[bytes(row["ending"])] = len(item_counts)
        item_counts.append(row["c"])
        item_words.append(row["words"])
    words, word_items = {}, []
    for row in head:
        word = bytes(row["word"])
        words[word] = len(word_items)
        if row["c"] * ITEMS >= total:
            word_items.append(len(item_counts))
            item_counts.append(row["c"])
            item_words.append(1)
        else:
            word_items.append(endings.get(word[-3:], _OTHER))
    single = np.zeros(len(item_counts), bool)
    single[1] = True
    single[2 + len(groups) :] = True
    return Vocabulary(
        total,
        distinct,
        words,
        np.array(word_items, np.int64),
        np.array([row["c"] for row in head], np.int64),
        endings,
        np.array(item_counts, np.int64),
        np.array(item_words, np.int64),
        single,
    )


def _stream(texts: Iterable[str], known: Vocabulary) -> np.ndarray:
    """Items of all texts in one row, each text between ends."""
    found: list[np.ndarray] = [np.array([1])]
    for text in texts:
        found += [known.items(tokens(text))[1], np.array([1])]
    return np.concatenate(found)


def item_bigrams(training: DataFrame, known: Vocabulary) -> DataFrame:
    """For each item the items before and after it, and how often each pair occurs."""
    shared = training.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(shared.value.item_counts)
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            stream = _stream(batch["text"], shared.value)
            new, counts = np.unique(stream[:-1] * size + stream[1:], return_counts=True)
            keys, places = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.bincount(places, np.concatenate([sums, counts]), len(keys)).astype(np.int64)
        yield pd.DataFrame({"before": keys // size, "after": keys % size, "n": sums})

    pairs = training.select("text").mapInPandas(count, "before bigint, after bigint, n bigint")
    pairs = written(pairs.groupBy("before", "after").agg(F.sum("n").alias("n")), "item-pairs")
    one = pairs.select(F.col("before").alias("item"), F.lit(True).alias("is_after"), F.col("after").alias("other"), "n")
    two = pairs.select(F.col("after").alias("item"), F.lit(False).alias("is_after"), F.col("before").alias("other"), "n")
    entry = F.struct("other", "n")
    # A list has at most one entry an item.
    lists = one.unionByName(two).groupBy("item").agg(
        F.collect_list(F.when(~F.col("is_after"), entry)).alias("before"),
        F.collect_list(F.when(F.col("is_after"), entry)).alias("after"),
    )
    lists = lists.select(
        "item",
        F.col("before.other").alias("before"),
        F.col("before.n").alias("n_before"),
        F.col("after.other").alias("after"),
        F.col("after.n").alias("n_after"),
    )
    return written(lists, "item-lists")


def _information(values: np.ndarray) -> np.ndarray:
    return values * np.log(np.maximum(values, 1))


def _context(classes: np.ndarray, others, counts) -> np.ndarray:
    return np.bincount(classes[np.asarray(others, np.int64)], np.asarray(counts, float), CLASSES)


def class_bigrams(lists: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of neighbouring classes; at most ``CLASSES`` squared rows come to the driver."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((CLASSES, CLASSES))
        for batch in batches:
            for item, others, counts in zip(batch["item"], batch["after"], batch["n_after"], strict=True):
                table[classes[item]] += _context(classes, others, counts)
        before, after = np.nonzero(table)
        yield pd.DataFrame({"before": before, "after": after, "n": table[before, after].astype(np.int64)})

    parts = lists.select("item", "after", "n_after").mapInPandas(count, "before int, after int, n bigint")
    table = np.zeros((CLASSES, CLASSES))
    for row in parts.groupBy("before", "after").agg(F.sum("n").alias("n")).collect():
        table[row["before"], row["after"]] = row["n"]
    return table


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class bigrams, up to what the classes cannot change."""
    return float(_information(table).sum() - _information(table.sum(axis=1)).sum() - _information(table.sum(axis=0)).sum())


def best_class(table: np.ndarray, own: int, before: np.ndarray, after: np.ndarray, itself: float) -> tuple[int, float]:
    """The class that an item should move to, and the gain in likelihood.

    ``before`` and ``after`` count the classes around the item; ``itself`` how often it follows itself.
    """
    left, right = before.copy(), after.copy()
    left[own] -= itself
    right[own] -= itself
    base = table.copy()
    base[own, :] -= right
    base[:, own] -= left
    base[own, own] -= itself
    # Whatever its class, the item's neighbours keep it in their own row or column.
    rows, columns = base.sum(axis=1) + left, base.sum(axis=0) + right
    n_after, n_before = right.sum() + itself, left.sum() + itself
    gain = (_information(base + right[None, :]) - _information(base)).sum(axis=1)
    gain += (_information(base + left[:, None]) - _information(base)).sum(axis=0)
    cell = base.diagonal()
    gain -= _information(cell + right) + _information(cell + left) - 2 * _information(cell)
    gain += _information(cell + right + left + itself) - _information(cell)
    gain -= _information(rows + n_after) - _information(rows)
    gain -= _information(columns + n_before) - _information(columns)
    gain[0] = -np.inf
    best = int(gain.argmax())
    return best, float(gain[best] - gain[own])


def exchange(lists: DataFrame, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the items, and the counts of neighbouring classes.

    A round proposes the best class for a third of the items, chosen anew each round, in parallel; the class counts are
    gathered again afterwards.  The classes with the largest likelihood of all rounds are kept.  The end has a class for
    itself.
    """
    size = len(known.item_counts)
    order = np.argsort(-known.item_counts, kind="stable")
    classes = np.zeros(size, np.int64)
    classes[order] = np.arange(size) % (CLASSES - 1) + 1
    classes[1] = 0
    table = class_bigrams(lists, classes)
    best = (likelihood(table), classes, table)
    idle = 0
    for number in range(3 * ROUNDS):
        now, seen = classes, table

        def propose(batches: Iterable[pd.DataFrame], now=now, seen=seen) -> Iterator[pd.DataFrame]:
            for batch in batches:
                moves = []
                for item, before, n_before, after, n_after in batch.itertuples(index=False, name=None):
                    sides = _context(now, before, n_before), _context(now, after, n_after)
                    itself = float(np.asarray(n_after)[np.asarray(after) == item].sum())
                    to, gain = best_class(seen, int(now[item]), *sides, itself)
                    if gain > 1e-6:
                        moves.append((item, to))
                yield pd.DataFrame(moves, columns=["item", "to"]).astype("int64")

        turn = lists.where((F.pmod(F.col("item") + number, F.lit(3)) == 0) & (F.col("item") != 1))
        moves = turn.mapInPandas(propose, "item bigint, to bigint").collect()
        idle = 0 if moves else idle + 1
        if idle == 3:
            break
        if moves:
            classes = classes.copy()
            for move in moves:
                classes[move["item"]] = move["to"]
            table = class_bigrams(lists, classes)
            best = max(best, (likelihood(table), classes, table), key=lambda found: found[0])
    return best[1], best[2]


class Scorer:
    """Logarithms of all factors, to base 10."""

    def __init__(self, known: Vocabulary, classes: np.ndarray, table: np.ndarray):
        self.known, self.classes = known, classes
        inside = np.bincount(classes, known.item_counts, CLASSES)
        kinds = np.bincount(classes, minlength=CLASSES)
        emitted = (known.item_counts + ADDED) / (inside[classes] + ADDED * kinds[classes])
        prior = (inside + ADDED) / (inside.sum() + ADDED * CLASSES)
        self.moves = np.log10((table + SMOOTHING * prior[None, :]) / (table.sum(axis=1, keepdims=True) + SMOOTHING))
        self.items = np.log10(emitted)
        self.within = np.where(known.single, 0.0, -np.log10(known.item_counts + ADDED * (known.item_words + 1)))
        self.base = -np.log10(known.total + ADDED * (known.distinct + 1))
        words = np.log10(known.word_counts + ADDED)
        self.head_base = words + self.base
        self.head_within = np.where(known.single[known.word_items], 0.0, words + self.within[known.word_items])
        ends = known.item_counts[1]
        self.end_base = np.log10(ends + ADDED) + self.base

    def read(self, text: str) -> tuple[int, int, float, float, list[tuple[bytes, int]]]:
        """Tokens, known ones, base score and score as far as no counts outside the head are needed, and those words."""
        found = tokens(text)
        heads, items = self.known.items(found)
        classes = np.concatenate([[self.classes[1]], self.classes[items], [self.classes[1]]])
        inside = heads[heads >= 0]
        score = self.moves[classes[:-1], classes[1:]].sum() + self.items[items].sum() + self.items[1]
        score += self.head_within[inside].sum() + self.within[items[heads < 0]].sum()
        base = self.head_base[inside].sum() + self.end_base
        rare = Counter(found[at] for at in np.flatnonzero(heads < 0).tolist())
        known = len(inside) + int(self.known.item_counts[1] > 0)
        return len(found) + 1, known, float(base), float(score), list(rare.items())


_ROWS = (
    "row bigint, word binary, n bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "base_score double, score double"
)


def score_texts(docs: DataFrame, counts: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    One row for each text and one for each of its distinct words outside the head; the latter meet their counts in a join,
    whose keys are rare by definition, and are summed by text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts, words = [], []
            for doc, held_out, text in zip(batch["doc_id"], batch["held_out"], batch["text"], strict=True):
                n_tokens, n_known, base, score, rare = shared.value.read(text)
                texts.append((number, None if pd.isna(doc) else int(doc), held_out, n_tokens, n_known, base, score))
                words += [(number, *entry) for entry in rare]
                number += 1
            names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
            own = pd.DataFrame(texts, columns=names).assign(word=None, n=None)
            own["doc_id"] = own["doc_id"].astype("Int64")
            yield own[[field.split()[0] for field in _ROWS.split(", ")]]
            for at in range(0, len(words), 200_000):
                part = pd.DataFrame(words[at : at + 200_000], columns=["row", "word", "n"])
                part = part.assign(doc_id=None, held_out=None, n_tokens=None, n_known=None, base_score=None, score=None)
                yield part[[field.split()[0] for field in _ROWS.split(", ")]]

    rows = docs.select(
        F.col("doc_id"), (~_is_training(F.col("doc_id"))).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInPandas(read, _ROWS)
    # A text's own row has no word and so meets no count; salted, such rows do not meet in one task either.
    total = scorer.known.total
    tail = counts.where((F.col("c") * HEAD < total) & (F.length("word") > 0))
    key = F.coalesce("word", F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary"))
    joined = rows.withColumn("key", key).join(tail.select(F.col("word").alias("key"), "c"), "key", "left")
    c = F.coalesce("c", F.lit(0))
    logs = F.col("n") * F.log10(c + F.lit(ADDED))
    values = joined.select(
        "row",
        "doc_id",
        "held_out",
        "n_tokens",
        F.coalesce("n_known", F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.coalesce("base_score", logs + F.col("n") * F.lit(float(scorer.base))).alias("base_score"),
        F.coalesce("score", logs).alias("score"),
    )
    sums = values.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        F.sum("base_score").alias("base_score"),
        F.sum("score").alias("score"),
    )
    return sums.drop("row")


def score_by_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learns from the rows whose ``crc32(key as text) mod 10`` is not 0 and scores all rows."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    training = rows.where(_is_training(F.col("doc_id")))
    counts = written(word_counts(training), "word-counts")
    known = vocabulary(counts)
    classes, table = exchange(item_bigrams(training, known), known)
    return score_texts(rows, counts, Scorer(known, classes, table))
