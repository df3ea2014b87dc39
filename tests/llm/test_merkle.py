"""The Merkle manifest against trees built in plain Python."""

import hashlib
import zlib

import pytest

from meterline.llm import merkle
from meterline.llm.common import numbered, written
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, digest string, pos string"
LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
    return found


def siblings(found, at):
    way = []
    for level in found[:-1]:
        first = at // 16 * 16
        way.append(("".join(level[first:at]), "".join(level[at + 1 : first + 16])))
        at //= 16
    return way


def brute(rows):
    by_source = {}
    for doc_id, source, lang, n_chars, text in rows:
        own = started = leaf((doc_id, source, lang, n_chars, text))
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0:
            started = leaf((doc_id, source, lang, n_chars, text and text.translate(LOWER)))
        by_source.setdefault(source, []).append((doc_id, own, started))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for source in sources:
        by_source[source].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [levels([x[1] for x in by_source[s]]) for s in sources]
    top = levels([tree[-1][0] for tree in trees])
    out = []
    for j, source in enumerate(sources):
        for i, (doc_id, own, node) in enumerate(by_source[source]):
            way = siblings(trees[j], i) + siblings(top, j)
            for left, right in way:
                node = sha(left, node, right)
            proof = sha(*[left + right for left, right in way])
            out.append((doc_id, own, trees[j][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(map(repr, out))


def proofs(spark, rows, every=merkle.STORED_EVERY):
    docs = spark.createDataFrame([(*row, "clash", "clash") for row in rows], SCHEMA)
    return sorted(repr(tuple(row)) for row in merkle.prove(merkle.build(docs, every)).collect())


def document(i, source):
    return (i, source, "en", 7, f"Text NUMBER {i}")


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 256, 257, 4097])
def test_sources_of_every_size(spark, size):
    rows = [document(i, "big") for i in range(size)] + [document(-i, f"s{i % 21}") for i in range(1, 60)]
    assert proofs(spark, rows) == brute(rows)


@pytest.mark.parametrize("every", [1, 3])
def test_stored_levels_do_not_show(spark, every):
    rows = [document(i, "big") for i in range(300)] + [document(1000 + i, f"s{i}") for i in range(20)]
    assert proofs(spark, rows, every) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None)] * 3 + [(None, "", "", 0, "")] + [(i % 3, None, "é", None, "ÄX") for i in range(20)]
    rows += [(5, "one", "en", 3, "same")] * 40 + [(5, "one", "en", 3, f"other {i}") for i in range(5)]
    assert proofs(spark, rows) == brute(rows)


def test_only_tampered_texts_fail(spark):
    rows = [document(i, "s") for i in range(100)] + [(1000 + i, "s", "en", 3, "low") for i in range(100)]
    docs = spark.createDataFrame([(*row, "", "") for row in rows], SCHEMA)
    found = {row["doc_id"]: row["verified"] for row in merkle.prove(merkle.build(docs)).collect()}
    assert found == {i: i >= 1000 or zlib.crc32(str(i).encode()) % 5 != 0 for i, *_ in rows}


def test_numbers_of_a_hot_group_and_of_one_repeated_row(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3000, "hot").otherwise("other").alias("g"), F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("v")
    )
    found = numbered(written(rows, "test"), "g", F.col("v")).collect()
    for group, size in (("hot", 3000), ("other", 1000)):
        own = sorted((row["pos"], row["v"], row["n"]) for row in found if row["g"] == group)
        assert [x[0] for x in own] == list(range(size))
        assert [x[1] for x in own] == sorted(x[1] for x in own)
        assert {x[2] for x in own} == {size}
