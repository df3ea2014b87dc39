"""The pipeline, stage by stage and as a whole, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import _plain_base, _plain_simhash

import corpus_pipeline
from meterline.llm import packing, personal_data

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    """What each stage returns, and what it was given."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        given = [row.asDict() for row in docs.collect()]
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        found[name] = given, [row.asDict() for row in docs.collect()]
    return found


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]


def _rule_failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words) < 50 or 100 * len(repeated) > 50 * len(words) or 100 * symbols > 30 * len(words)


def test_quality(outputs):
    given, kept = outputs["quality"]
    failed = {row["doc_id"]: _rule_failed(row["text"]) for row in given}
    texts, failures = Counter(row["source"] for row in given), Counter(row["source"] for row in given if failed[row["doc_id"]])
    rates = np.array([failures[s] / n for s, n in texts.items()])
    mean, variance = rates.mean(), rates.var()
    strength = max(mean * (1 - mean) / variance - 1, 1)
    rejected = {s for s, n in texts.items() if (failures[s] + strength * mean) / (n + strength) > 0.5}
    expected = [row for row in given if not failed[row["doc_id"]] and row["source"] not in rejected]
    key = lambda row: row["doc_id"]
    assert sorted(kept, key=key) == sorted(expected, key=key)
    assert 0 < len(kept) < len(given)


def test_near_duplicates(outputs):
    given, kept = outputs["near_duplicates"]
    prints = {row["doc_id"]: _plain_simhash(row["text"]) for row in given}
    ids = sorted(prints)
    values, parent = np.array([prints[i] for i in ids], np.uint64), {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ values[k]) <= 2).tolist():
            a, b = root(i), root(ids[j])
            parent[max(a, b)] = min(a, b)
    assert sorted(row["doc_id"] for row in kept) == sorted({root(i) for i in ids})
    by_id = {row["doc_id"]: row for row in given}
    assert all(row == by_id[row["doc_id"]] for row in kept)
    assert len(kept) < len(given)


def test_personal_data(outputs):
    given, cleaned = outputs["personal_data"]
    before = {row["doc_id"]: row for row in given}
    assert sorted(before) == sorted(row["doc_id"] for row in cleaned)
    changed = 0
    for row in cleaned:
        old = before[row["doc_id"]]
        assert not _plain_base(row["text"])
        assert row["n_chars"] == len(row["text"])
        assert (row["lang"], row["source"]) == (old["lang"], old["source"])
        if not re.search("[0-9@]", old["text"]):
            assert row["text"] == old["text"]
        pattern = "".join(re.escape(part) if i % 2 == 0 else ".+" for i, part in enumerate(re.split(r"(\[(?:EMAIL|IP|CARD|PHONE)\])", row["text"])))
        assert re.fullmatch(pattern, old["text"], re.S)
        changed += row["text"] != old["text"]
    assert changed >= sum(bool(_plain_base(row["text"])) for row in given) > 0


def _unit(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:12], 16) / 2**48


def test_mixing(outputs):
    given, mixed = outputs["mixing"]
    texts = Counter(row["source"] for row in given)
    shares = {s: math.sqrt(n) for s, n in texts.items()}
    rates = {s: shares[s] / sum(shares.values()) * len(given) / n for s, n in texts.items()}

    def copies(rate, at):
        k, term = 0, math.exp(-rate)
        most = term
        while most <= at:
            k += 1
            term *= rate / k
            most += term
        return k

    fields = lambda row: "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row.values())
    identity = lambda row: hashlib.md5(fields(row).encode()).hexdigest() + ":1"
    expected = {row["doc_id"]: copies(rates[row["source"]], _unit("mix-1", identity(row))) for row in given}
    assert Counter(row["doc_id"] for row in mixed) == Counter({i: n for i, n in expected.items() if n})
    by_id = {row["doc_id"]: row for row in given}
    assert all(row == by_id[row["doc_id"]] for row in mixed)


def test_packing(outputs):
    given, pieces = outputs["packing"]
    encode = packing.encoder(ranks=None)
    tokens = {row["doc_id"]: np.append(encode(row["text"]), np.uint32(1)) for row in given}
    times = Counter(row["doc_id"] for row in given)
    held, sequences = defaultdict(Counter), defaultdict(list)
    for piece in pieces:
        part = tokens[piece["doc_id"]][piece["start"] : piece["start"] + piece["length"]]
        assert len(part) == piece["length"] > 0
        held[piece["doc_id"]].update(range(piece["start"], piece["start"] + piece["length"]))
        sequences[piece["sequence_id"]].append((piece["offset"], piece["length"]))
    assert all(held[i] == Counter({at: n for at in range(len(tokens[i]))}) for i, n in times.items())
    lengths = []
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        lengths.append(at)
    assert max(lengths) <= packing.LENGTH and sum(n < packing.LENGTH for n in lengths) <= 1


def test_run_gives_what_the_stages_give(spark, outputs):
    names = ("doc_id", "start", "length", "ids_crc32")
    found = Counter(tuple(row[n] for n in ("doc_id", "doc_tokens")) for row in corpus_pipeline.run(spark, SF).collect() if row["start"] == 0)
    assert found == Counter((row["doc_id"], row["doc_tokens"]) for row in outputs["packing"][1] if row["start"] == 0)
    assert set(names) <= set(outputs["packing"][1][0])


def test_one_of_repeated_rows_and_of_rows_without_key_stays(spark):
    docs = spark.createDataFrame(
        [(7, "a b c d", "x"), (7, "a b c d", "x"), (None, "a b c d", "y"), (None, "other words here now", "y"), (None, "other words here now", "z"), (9, None, "x"), (10, "", "x")],
        "doc_id long, text string, source string",
    )
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == [("7", "a b c d"), ("9", "None"), ("None", "other words here now")]


def test_texts_under_one_id_are_documents_of_their_own(spark):
    docs = spark.createDataFrame(
        [(8, "one text of some words", "y"), (8, "something else altogether", "x"), (8, "one text of some words", "x"), (9, "something else altogether", "x")],
        "doc_id long, text string, source string",
    )
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(map(tuple, kept.collect())) == [(8, "one text of some words", "x"), (8, "something else altogether", "x")]


def test_redaction_of_a_null_text(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "call +1 (988) 555-2485", 22)], "doc_id long, text string, n_chars long")
    rows = {r["doc_id"]: r for r in corpus_pipeline.personal_data(spark, docs, "").collect()}
    assert (rows[1]["text"], rows[1]["n_chars"]) == (None, 5)
    assert (rows[2]["text"], rows[2]["n_chars"]) == ("call [PHONE]", 12)
    assert personal_data.redact("ab cd", [("ip", 0, 2), ("card", 1, 5)]) == "[IP]"
