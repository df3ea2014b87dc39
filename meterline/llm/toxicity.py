"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Whole texts are compared by all their words, with document frequencies counted over all documents.  The index has the
examples of each rarer word, and of the ``FREQUENT`` most frequent ones the largest weight in each block of examples: what
the rare words give is exact, what the frequent ones can add is bounded by block, and only examples that may be among the
nearest are compared in full.  An example close to the text, a copy above all, decides by its label, the more the closer it
is (from ``NEAR`` on; at 1 alone).

Farther away, a few words tell more than the whole text.  For that, terms are lower-case words and their first four, five and six letters.  Of these, the terms that toxic examples have
clearly more often than others (log-likelihood ratio) span the space in which texts are compared; all other words of a
text are one further term.  Examples lie in blocks, and a block keeps each term's largest weight in it.  The product of a text with those is an upper bound for the
whole block, so blocks are read by falling bound until the bound is no better than the k-th best example found: the
result is that of comparing with all examples.  Near examples count more; the vote is turned into a probability by a
logistic curve fitted to the examples, each judged by the others.  Examples without any chosen term are alike: they
stand in the ranking as often as needed, with the share of toxic ones among them.  A text without any such term has just
that share.

Fitted to a bounded sample: per label at most ``SAMPLE_DOCS`` training rows, those with the smallest hashes, and as many of
them as ``SAMPLE_CHARS`` characters allow; the two labels are weighted back to their numbers among all training rows.  All texts are scored whole.

Rows: NULL text counts as empty; labels that are NULL, or whose document is missing, are not used; a document with several
labels is an example of each; of equally near examples the one with the smaller place in the sample comes first; without any example of both labels the score is the toxic share of all (0 without labels).
"""

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import bucket, smallest_hashes_by, written

FOLDS = 5
SAMPLE_DOCS = 6_000
SAMPLE_CHARS = 50_000_000
FREQUENT = 512
#: Cosine of whole texts from which an example's label counts by itself.
NEAR = 0.8
#: The frequent words of a text that are left aside first: as many as have this part of a wanted cosine for their length.
REST = 0.85
MOST_TERMS = 4_000
LEAST_RATIO = 20.0
LEAST_TIMES = 4.0
NEIGHBOURS = 15
BLOCK = 64
EVIDENCE = 3

_word = re.compile(r"[^\W\d_]+")
#: Of ASCII, all but letters becomes a space.
_letters = {i: i if chr(i).isalpha() else 32 for i in range(128)}


def all_words(text: str) -> list[str]:
    """The words of a text in lower case, in order; for ASCII without a pattern, which takes a quarter of the time."""
    text = text.lower()
    return text.translate(_letters).split() if text.isascii() else _word.findall(text)


def terms_of(text: str) -> set[str]:
    found = set(all_words(text))
    return found | {word[:n] + "*" for word in found for n in (4, 5, 6) if len(word) > n}


def words_of(text: str) -> Counter:
    return Counter(all_words(text))


def heads_of(known: Iterable[str]) -> set[str]:
    """What the known terms begin with: a word that begins otherwise has none of them."""
    return {term.removesuffix("*")[:4] for term in known}


@lru_cache(4096)
def _damped(n: int) -> float:
    return float(1 + np.log(n))


def counted(counts: Counter, known: dict[str, int], heads: set[str]) -> dict[int, int]:
    """How often a text of these words has each known term, and under 0 its other words; nothing if it has no known term."""
    found: dict[int, int] = {}
    possible = [word for word in counts if word[:4] in heads]
    others = counts.total() - sum(counts[word] for word in possible)
    for word in possible:
        n = counts[word]
        at = known.get(word)
        plain = at is None
        if not plain:
            found[at] = n
        for length in (4, 5, 6):
            at = known.get(word[:length] + "*") if len(word) > length else None
            if at is not None:
                found[at] = found.get(at, 0) + n
                plain = False
        others += n * plain
    if found and others:
        found[0] = others
    return found


class Index:
    """Unit vectors of examples in blocks with the largest weight of each term."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int):
        self.blocks = []
        self.most = np.zeros((n_terms, -(-len(vectors) // BLOCK)), np.float32)
        #: Where in a block each term is, -1 if it is not.
        self.place = np.full((n_terms, self.most.shape[1]), -1, np.int32)
        for number, at in enumerate(range(0, len(vectors), BLOCK)):
            own = vectors[at : at + BLOCK]
            terms = np.array(sorted({term for vector in own for term in vector}), np.int64)
            where = {term: i for i, term in enumerate(terms.tolist())}
            dense = np.zeros((len(terms), len(own)), np.float32)
            for column, vector in enumerate(own):
                for term, weight in vector.items():
                    dense[where[term], column] = weight
            self.blocks.append((at, dense))
            if len(terms):
                self.most[terms, number] = dense.max(axis=1)
                self.place[terms, number] = np.arange(len(terms))

    def nearest(self, vector: dict[int, float], k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the k nearest examples, nearest first; example ``without`` is left out."""
        terms = np.array(sorted(vector), np.int64)
        weights = np.array([vector[t] for t in terms.tolist()], np.float32)
        bounds = weights @ self.most[terms]
        places = np.ascontiguousarray(self.place[terms].T)
        examples, cosines = np.zeros(0, np.int64), np.zeros(0, np.float32)
        #: What an example must exceed to be among the k nearest so far.
        least = 0.0
        upper = np.minimum(bounds, 1.0).tolist()
        for number in np.argsort(-bounds, kind="stable").tolist():
            if len(examples) >= k and upper[number] <= float(cosines[k - 1] + 1e-6) or upper[number] <= 0:
                break
            at, dense = self.blocks[number]
            place = places[number]
            there = place >= 0
            found = weights[there] @ dense[place[there]]
            if at <= without < at + len(found):
                found[without - at] = 0.0
            better = np.flatnonzero(found > least)
            if not len(better):
                continue
            examples = np.concatenate([examples, better + at])
            cosines = np.concatenate([cosines, found[better]])
            order = np.argsort(-cosines, kind="stable")[:k]
            examples, cosines = examples[order], cosines[order]
            if len(examples) >= k:
                least = cosines[k - 1]
        return examples, cosines


class WholeIndex:
    """Unit vectors of whole texts over all words of the examples: lists of rare words, block maxima of frequent ones."""

    def __init__(self, texts: list[str], frequencies: dict[str, int], documents: int):
        place: dict[str, int] = {}
        terms, times = [], []
        for text in texts:
            count = words_of(text)
            terms.append(np.array([place.setdefault(word, len(place)) for word in count], np.uint32))
            times.append(np.array(list(count.values()), np.uint32))
        lengths = np.array([len(own) for own in terms], np.int64)
        terms, times = np.concatenate(terms), np.concatenate(times)
        times = times.astype(np.uint16) if times.max(initial=0) < 1 << 16 else times
        own, words = np.bincount(terms, minlength=len(place)).tolist(), list(place)
        order = sorted(range(len(words)), key=lambda i: (-own[i], words[i]))
        ranked = [words[i] for i in order]
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        found = np.array([frequencies.get(word, 0) for word in ranked] + [0], np.float64)
        #: The last one is for words that no example has.
        inverse = np.log((documents + 1) / (np.minimum(found, documents) + 1)) + 1
        self.given, self.place = (ranked, inverse, rank[terms], times, lengths), None

    def __getstate__(self):
        """Words and how often each example has them; weights are worked out again where the index is read."""
        return self.given

    def __setstate__(self, given) -> None:
        self.given, self.place = given, None

    def _read(self) -> None:
        ranked, self.inverse, terms, times, lengths = self.given
        self.place = {word: i for i, word in enumerate(ranked)}
        self.size, terms = len(lengths), terms.astype(np.int64)
        examples = np.repeat(np.arange(self.size), lengths)
        weights = (1 + np.log(times.astype(np.float64))) * self.inverse[terms]
        norms = np.sqrt(np.bincount(examples, weights * weights, self.size))
        weights = (weights / norms[examples]).astype(np.float32)
        often = terms < FREQUENT
        self.blocks = np.arange(self.size) // BLOCK
        self.frequent = np.zeros((min(FREQUENT, len(ranked)), self.size), np.float32)
        self.frequent[terms[often], examples[often]] = weights[often]
        terms, examples, weights = terms[~often], examples[~often], weights[~often]
        order = np.argsort(terms, kind="stable")
        self.examples, self.weights = examples[order].astype(np.int32), weights[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(ranked) + 1))
        edges = np.arange(0, self.size, BLOCK)
        self.most = np.maximum.reduceat(self.frequent, edges, axis=1) if len(self.frequent) else np.zeros((0, len(edges)), np.float32)

    def vector(self, count: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Terms that an example has, ascending, and their weights in the unit vector of all words."""
        last = len(self.place)
        terms = np.fromiter(map(self.place.get, count, repeat(last)), np.int64, len(count))
        weights = (1 + np.log(np.fromiter(count.values(), np.float64, len(count)))) * self.inverse[terms]
        norm = np.sqrt(weights @ weights)
        order = np.flatnonzero(terms < last)
        order = order[np.argsort(terms[order], kind="stable")]
        return terms[order], (weights[order] / norm if norm else weights[order]).astype(np.float32)

    def _sums(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What these terms, none of them frequent, add to the cosine of each example."""
        begin, end = self.starts[terms], self.starts[terms + 1]
        lengths = end - begin
        at = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return np.bincount(self.examples[at], self.weights[at] * np.repeat(weights, lengths), self.size)

    def _all_below(self, terms: np.ndarray, weights: np.ndarray, often: int, least: float) -> bool:
        """Whether the rarest terms alone, whose lists are short, tell that no example reaches ``least``.

        Examples are unit vectors, so what all other terms can add is at most the length of their part of this one.
        """
        squares = np.cumsum(weights.astype(np.float64) ** 2)
        cut = max(often, int(np.searchsorted(squares, (REST * least) ** 2)))
        rest = np.sqrt(squares[cut - 1]) if cut else 0.0
        if rest >= least - 1e-4:
            return False
        return bool(self._sums(terms[cut:], weights[cut:]).max(initial=0.0) + rest < least - 1e-4)

    def nearest(self, words: Counter, k: int, without: int = -1, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the k nearest examples that share a word, nearest first; ``without`` is left out.

        Those below ``least`` are not wanted, and their blocks, whose bounds tell, need not be read.
        """
        if self.place is None:
            self._read()
        terms, weights = self.vector(words)
        often = int(np.searchsorted(terms, len(self.frequent)))
        if least and self._all_below(terms, weights, often, least):
            return np.zeros(0, np.int64), np.zeros(0)
        rare = self._sums(terms[often:], weights[often:])
        bound = rare + (weights[:often] @ self.most[terms[:often]])[self.blocks]
        if 0 <= without < self.size:
            rare[without] = bound[without] = -1.0
        # The k-th best is not below the k-th best sum of rare words.
        left = np.flatnonzero(bound >= max(least - 1e-6, 1e-6))
        if len(left) > k:
            enough = np.partition(rare, self.size - k)[self.size - k]
            left = left[bound[left] >= enough - 1e-6]
        cosines = rare[left] + weights[:often] @ self.frequent[terms[:often][:, None], left]
        order = np.lexsort((left, -cosines))[:k]
        order = order[cosines[order] >= max(least - 1e-6, 1e-6)]
        return left[order], np.minimum(cosines[order], 1.0)


class Model:
    def __init__(self, examples: list[tuple], totals: dict[int, int], frequencies: dict[str, int] | None = None, documents: int = 0):
        """``examples``: (doc_id, toxic, text); ``totals``: training rows by label; document frequencies of the examples' words."""
        self.all_ids = [doc for doc, _, _ in examples]
        self.all_toxic = np.array([toxic for _, toxic, _ in examples], np.float64)
        self.whole = WholeIndex([text for _, _, text in examples], frequencies or {}, documents) if examples else None
        sampled = Counter(toxic for _, toxic, _ in examples)
        everything = sum(totals.values())
        self.share = totals.get(1, 0) / everything if everything else 0.0
        self.known: dict[str, int] = {}
        self.index = None
        self.default = self.share
        if not sampled[0] or not sampled[1]:
            return
        weight = {label: totals[label] / sampled[label] for label in (0, 1)}
        self._choose_terms(examples, sampled)
        frequency = np.zeros(len(self.known) + 1)
        counts = [counted(words_of(text), self.known, self.heads) for _, _, text in examples]
        for (_, toxic, _), own in zip(examples, counts, strict=True):
            for term in own:
                frequency[term] += weight[toxic]
        self.inverse = np.log((everything + 1) / (frequency + 1)) + 1
        self.inverse[0] = 1.0
        within = [i for i, own in enumerate(counts) if own]
        without = Counter(examples[i][1] for i, own in enumerate(counts) if not own)
        rest = {label: weight[label] * without[label] for label in (0, 1)}
        self.default = (rest[1] + self.share) / (rest[0] + rest[1] + 1)
        self.plain_weight = (rest[0] + rest[1]) / max(1, without[0] + without[1])
        self.ids = np.array([-1 if examples[i][0] is None else examples[i][0] for i in within], np.int64)
        self.toxic = np.array([examples[i][1] for i in within], np.int64)
        self.weight = np.array([weight[label] for label in self.toxic])
        vectors = [self.vector(counts[i]) for i in within]
        self.curve = (0.0, 1.0)
        if vectors:
            self.index = Index(vectors, len(self.known) + 1)
            votes = np.array([self._vote(v.get(0, 0.0), *self.index.nearest(v, NEIGHBOURS, i)) for i, v in enumerate(vectors)])
            self.curve = self._logistic(votes, self.toxic, self.weight)

    def _choose_terms(self, examples: list[tuple], sampled: Counter) -> None:
        """Terms by log-likelihood ratio of their document frequency under the two labels."""
        by_label = {0: Counter(), 1: Counter()}
        for toxic, text in {(toxic, text) for _, toxic, text in examples}:
            by_label[toxic].update(terms_of(text))
        scored = []
        for term, a in by_label[1].items():
            if a < 3:
                continue
            b, n, m = by_label[0][term], sampled[1], sampled[0]
            if a * m < LEAST_TIMES * b * n:
                continue
            common = (a + b) / (n + m)
            ratio = 2 * (a * np.log(a / (n * common)) + (b * np.log(b / (m * common)) if b else 0))
            if ratio >= LEAST_RATIO:
                scored.append((-ratio, term))
        self.known = {term: i for i, (_, term) in enumerate(sorted(scored)[:MOST_TERMS], 1)}
        self.heads = heads_of(self.known)

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        weights = {term: _damped(n) * float(self.inverse[term]) for term, n in counts.items()}
        norm = np.sqrt(sum(w * w for w in weights.values()))
        return {term: w / norm for term, w in weights.items()}

    def _vote(self, plain: float, examples: np.ndarray, cosines: np.ndarray) -> float:
        """Toxic share of the nearest examples.  ``plain`` is the cosine to examples without any chosen term."""
        nearer = cosines > plain
        examples, cosines = examples[nearer], np.minimum(cosines[nearer], 1.0)
        votes = self.weight[examples] / (1.05 - cosines)
        rest = (NEIGHBOURS - len(examples)) * self.plain_weight / (1.05 - min(plain, 1.0)) if plain > 0 else 0.0
        total = votes.sum() + rest
        return float((votes @ self.toxic[examples] + rest * self.default) / total) if total else self.share

    @staticmethod
    def _logistic(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
        """Intercept and slope of the penalised logistic fit, the slope at least 1, by Newton steps."""
        at = np.array([-2.0, 4.0])
        inputs = np.stack([np.ones(len(votes)), votes])
        weight = weight / weight.mean()
        for _ in range(40):
            chance = 1 / (1 + np.exp(-np.clip(at @ inputs, -30, 30)))
            slope = inputs @ (weight * (toxic - chance)) - 0.01 * (at - np.array([-2.0, 4.0]))
            curvature = (inputs * (weight * chance * (1 - chance))) @ inputs.T + 0.01 * np.eye(2)
            step = np.linalg.solve(curvature, slope)
            at = at + np.clip(step, -2, 2)
        return float(at[0]), max(float(at[1]), 1.0)

    def score(self, text: str) -> tuple[float, list[int]]:
        """Probability of the toxic label, and the nearest examples."""
        words = words_of(text)
        chance, evidence = self._by_terms(words)
        if self.whole is None:
            return chance, evidence
        near, cosines = self.whole.nearest(words, NEIGHBOURS, least=NEAR)
        if not len(near):
            return chance, evidence
        votes = 1 / (1.02 - cosines)
        own = float(votes @ self.all_toxic[near] / votes.sum())
        part = max(float(cosines[0]) - NEAR, 0.0) / (1 - NEAR)
        return float(np.clip(part * own + (1 - part) * chance, 0.0, 1.0)), [self.all_ids[i] for i in near[:EVIDENCE]]

    def _by_terms(self, words: Counter) -> tuple[float, list[int]]:
        own = counted(words, self.known, self.heads) if self.index else {}
        if not own:
            return float(self.default), []
        vector = self.vector(own)
        examples, cosines = self.index.nearest(vector, NEIGHBOURS)
        chance = 1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * self._vote(vector.get(0, 0.0), examples, cosines))))
        return float(np.clip(chance, 0.0, 1.0)), self.ids[examples[:EVIDENCE]].tolist()


def document_frequencies(docs: DataFrame, text: str, words: set[str]) -> tuple[dict[str, int], int]:
    """In how many of all documents each of the words, those of a bounded sample, occurs; and the number of documents.

    Each task counts its documents and sends one row for each word.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, documents = Counter(), 0
        for batch in batches:
            for own in batch["text"]:
                found.update(wanted.value.intersection(all_words(own)))
            documents += len(batch)
        yield pd.DataFrame({"word": [None, *found], "n": [documents, *found.values()]})

    parts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(count, "word string, n bigint")
    sums = {row["word"]: row["n"] for row in parts.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}
    return sums, sums.pop(None, 0)


def fitted(docs: DataFrame, labels: DataFrame, key: str, text: str, toxic: str) -> Model:
    """The model of the training rows; at most twice ``SAMPLE_DOCS`` texts and ``SAMPLE_CHARS`` characters come to the driver."""
    marked = labels.select(F.col(key).alias("key"), F.col(toxic).cast("int").alias("toxic"))
    marked = marked.where((bucket(F.col("key"), FOLDS) != 0) & F.col("toxic").isin(0, 1))
    totals = {row["toxic"]: row["n"] for row in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Labels of one document that agree are one example, however often they are given.
    chosen = smallest_hashes_by(marked, "toxic", SAMPLE_DOCS, "key").select("key", F.col("group").alias("toxic"))
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # At most twice SAMPLE_DOCS short rows are sent out; of texts that share an id, so many that the sample does not grow.
    found = texts.join(F.broadcast(chosen), "key").select("key", "toxic", "text")
    found = written(smallest_hashes_by(found, "toxic", SAMPLE_DOCS, "key", "text"), "examples")
    so_far = Window.partitionBy("group").orderBy("hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = found.select("group", "hash", F.sum(F.length("text")).over(so_far).alias("upto"))
    found = found.join(F.broadcast(sizes.where(F.col("upto") <= SAMPLE_CHARS // 2)), ["group", "hash"]).collect()
    rows = sorted((row["key"], row["group"], row["text"]) for row in found)
    shuffled = np.random.RandomState(11).permutation(len(rows))
    words = {word for _, _, own in rows for word in all_words(own)}
    return Model([rows[i] for i in shuffled], totals, *document_frequencies(docs, text, words))


def score_toxicity(docs: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """doc_id, held_out, score, predicted and the nearest labelled examples of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value.score(text) for text in batch["text"]]
            scores = np.array([value for value, _ in found])
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "held_out": batch["held_out"],
                    "score": scores,
                    "predicted": (scores >= 0.5).astype(np.int32),
                    "evidence": [examples for _, examples in found],
                }
            )

    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        (bucket(F.col(key), FOLDS) == 0).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return rows.mapInPandas(score, "doc_id bigint, held_out boolean, score double, predicted int, evidence array<bigint>")
