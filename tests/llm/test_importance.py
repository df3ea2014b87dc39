"""Word runs, gains and the draw against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from meterline.llm import importance as imp

ODD = ["", "a", "Été ABC déf  𝄞x İ", "x" * 64 + " " + "y" * 65 + " z " + "é" * 40 + " w", "x" * 3000, "a b", "a-b_c", "...", "\x00a\x7fb", "q" * 63 + " " + "r" * 64]


def runs(text):
    words = [w for w in re.split(imp.SEPARATORS, text.translate(imp.ASCII_LOWER)) if w]
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def buckets(text):
    return Counter(zlib.crc32(run.encode()) % 10_000 for run in runs(text)[1])


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_buckets_of_all_runs(monkeypatch, piece):
    monkeypatch.setattr(imp, "PIECE", piece)
    featurizer = imp.Featurizer()
    for begin, end in imp._groups(ODD):
        for text, (words, found) in zip(ODD[begin:end], featurizer(ODD[begin:end]), strict=True):
            assert words == len(runs(text)[0])
            assert Counter(found.tolist()) == buckets(text)


def brute(rows, targets):
    corpus, target = Counter(), Counter()
    for _, text in rows:
        corpus += buckets(text or "")
    for text in targets:
        target += buckets(text or "")
    more, less = sum(corpus.values()) + 10_000, sum(target.values()) + 10_000
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1) * more / ((corpus[b] + 1) * less)))
    scored = []
    for key, text in rows:
        found = buckets(text or "")
        weight = sum(gain(b) * n for b, n in found.items())
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([len(runs(text or "")[0]) < 20, -score, key is None, key or 0, sum(found.values()), key, weight])
    scored.sort(key=lambda x: x[:5])
    drawn = sum(not x[0] for x in scored) * 5 // 100
    return sorted((repr((x[5], x[4], x[6], -x[1], i + 1 if i < drawn else None)) for i, x in enumerate(scored)))


def test_draw_with_ties_nulls_and_repeated_rows(spark):
    prose = "the quick brown fox jumps over the lazy dog while seven other animals look on and say nothing at all about it"
    rows = [(i, f"{prose} number {i % 50} of {i % 7}") for i in range(300)] + list(enumerate(ODD)) + [(None, None), (None, prose), (3, None)]
    rows += [(77, prose)] * 120 + [(78, prose + " " + prose)] * 3
    targets = ["seven other animals", None, "", "brown fox 7"]
    docs = spark.createDataFrame([(*row, "clash", "clash") for row in rows], "doc_id bigint, text string, pos string, n string")
    target = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id bigint, text string")
    found = imp.resample(docs.repartition(5), target).drop("n_words").collect()
    assert sorted(repr(tuple(row)) for row in found) == brute(rows, targets)


def test_a_target_draws_its_like(spark):
    ours = [(i, "alpha beta gamma delta " * 6) for i in range(40)]
    other = [(100 + i, f"one two three {i} " * 6) for i in range(400)]
    docs = spark.createDataFrame(ours + other, "doc_id bigint, text string")
    target = spark.createDataFrame([(0, "alpha beta gamma delta " * 50)], "item_id bigint, text string")
    drawn = [row["doc_id"] for row in imp.resample(docs, target).where("rank IS NOT NULL").collect()]
    assert len(drawn) == 22 and all(key < 100 for key in drawn)
