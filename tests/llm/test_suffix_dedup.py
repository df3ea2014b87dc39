"""Suffix sorting and the removal of repeated strings against plain Python."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from meterline.llm import induced, suffix_dedup
from meterline.llm.queries import queries

LEAST = 50


def plain_suffixes(strings):
    text = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + 1, 0) for s in strings])
    keys, at = {}, 0
    for k, own in enumerate(strings):
        for i in range(len(own)):
            keys[at + i] = (tuple(own[i:]), k)
        at += len(own) + 1
    order = sorted(keys, key=lambda p: ((*[x + 1 for x in keys[p][0]], 0), keys[p][1]), reverse=True)

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    return text.astype(np.uint16), order, [common(keys[a][0], keys[b][0]) for a, b in zip(order, order[1:], strict=False)]


@pytest.mark.parametrize("limit", [1 << 30, 3])
@pytest.mark.parametrize("letters", [1, 2, 4, 26])
def test_suffixes_and_common_prefixes(limit, letters, monkeypatch):
    """With a limit of three tuples everything goes through files, and names are sorted by induction again."""
    monkeypatch.setattr(induced, "CHUNK", 1 << 18 if limit > 3 else 7)
    draw = random.Random(letters)
    for _ in range(60):
        strings = [bytes(draw.choices(range(97, 97 + letters), k=draw.randint(1, 40))) for _ in range(draw.randint(1, 6))]
        text, order, common = plain_suffixes(strings)
        pieces = list(induced.suffixes(text, 257, limit))
        assert np.concatenate([pos for pos, _, _ in pieces]).tolist() == order
        assert np.concatenate([lcp for _, lcp, _ in pieces]).tolist()[1:] == common


def brute(rows):
    """Rows (doc_id, text): what each keeps."""
    key = lambda doc: suffix_dedup.NO_ID if doc is None else doc
    least = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - LEAST + 1):
            own = data[i : i + LEAST]
            least[own] = min(least.get(own, key(doc)), key(doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - LEAST + 1):
            if least[data[i : i + LEAST]] < key(doc):
                gone[i : i + LEAST] = b"\1" * LEAST
        kept = bytes(x for x, y in zip(data, gone, strict=True) if not y)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append(repr((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*row, "clash", "clash") for row in rows], "doc_id bigint, text string, doc string, data string")
    out = suffix_dedup.without_repeats(docs.repartition(3), **options).collect()
    return sorted(
        repr((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest()))
        for r in out
    )


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    prose = lambda n: " ".join("".join(draw.choices("abcdeéß", k=draw.randint(1, 8))) for _ in range(n))
    passages = [prose(n) for n in (8, 12, 20, 60)] + ["x" * 400, "ab" * 90, "é" * 25, "y" * 49, "z" * 50]
    rows = []
    for i in range(150):
        parts = [draw.choice(passages) if draw.random() < 0.4 else prose(draw.randint(1, 15)) for _ in range(draw.randint(1, 6))]
        rows.append((draw.randrange(-20, 120), draw.choice((" ", "")).join(parts)))
    rows += [(None, None), (None, passages[3]), (None, passages[3] + "!"), (200, ""), (201, None), (202, passages[3])]
    rows += [(7, rows[0][1])] * 5 + [(300 + i % 3, rows[1][1]) for i in range(6)]
    return rows


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"limit": 100}])
def test_what_is_kept(spark, rows, options):
    """The same in one shard, with most hashes hot, and with arrays and queues in files."""
    assert found(spark, rows, **options) == brute(rows)


def windows_of(texts):
    """(text, window in it) -> hash."""
    starts = np.append(0, np.cumsum([len(text) for text in texts]))
    found = {}
    for _, *runs in suffix_dedup.window_runs(texts):
        for text, first, last, own in zip(*[x.tolist() for x in runs], strict=True):
            for window in range(first, last + 1):
                assert (text, window - starts[text]) not in found
                found[text, window - starts[text]] = own
    return found


@pytest.mark.parametrize("piece", [64, 1 << 16])
def test_every_window_lies_in_one_run(rows, monkeypatch, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    texts = [(text or "").encode() for _, text in rows]
    assert sorted(windows_of(texts)) == [(i, w) for i, text in enumerate(texts) for w in range(len(text) - LEAST + 1)]


def test_equal_windows_have_equal_hashes(rows):
    texts = [(text or "").encode() for _, text in rows]
    hashes = {}
    for (i, w), own in windows_of(texts).items():
        assert hashes.setdefault(texts[i][w : w + LEAST], own) == own


def test_digests_of_equal_strings_are_equal():
    draw = random.Random(9)
    data = bytes(draw.choices(range(97, 99), k=3000)) * 2
    starts = np.array([draw.randrange(2900) for _ in range(400)])
    ends = starts + np.array([draw.randrange(1, 90) for _ in range(400)])
    digest = suffix_dedup.Digests(LEAST)
    here, there = (digest(np.frombuffer(data, np.uint8), starts + shift, ends + shift) for shift in (0, 3000))
    assert here.tolist() == there.tolist()
    assert len(set(here.tolist())) == len({data[a:b] for a, b in zip(starts, ends, strict=True)})


def test_rows_are_worked_on_in_small_tables(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 10)
    batches = [pd.DataFrame({"data": [b"x" * n for n in own]}) for own in ([3, 4, 50, 0, 1, 2], [], [9, 9])]
    parts = [[len(x) for x in part["data"]] for part in suffix_dedup._together(batches)]
    assert [n for part in parts for n in part] == [3, 4, 50, 0, 1, 2, 9, 9]
    assert all(sum(part[:-1]) <= 60 for part in parts) and len(parts) > 3


def test_query_on_all_documents_equals_brute_force(spark, sf_dir):
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    query = queries()["op12_induced_suffixes"](spark, sf_dir)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(repr(tuple(row[c] for c in columns)) for row in query.collect()) == brute(rows)


class Sent:
    def __init__(self, value):
        self.value = value


def random_text(draw, n):
    return bytes(draw.choices(range(97, 123), k=n))


def kinds_of(spark, texts, hot=100):
    counts = pd.concat(suffix_dedup._hash_counter(LEAST, 1)([pd.DataFrame({"data": texts})]))
    judged = pd.concat([suffix_dedup._judge(hot)(own) for _, own in counts.groupby("bucket")])
    rows = [tuple(row) for row in judged.astype(object).itertuples(index=False)]
    return suffix_dedup._Kinds(Sent(suffix_dedup._bits(spark.createDataFrame(rows, suffix_dedup.KINDS), 1, 1000)))


def test_what_is_copied_as_a_whole_travels_as_one_run(spark):
    """A copied text is one run, and so is a copied passage but for the runs that reach over its ends."""
    draw = random.Random(4)
    whole, passage = random_text(draw, 3000), random_text(draw, 2000)
    texts = [whole, random_text(draw, 900), whole, random_text(draw, 300) + passage + random_text(draw, 400), random_text(draw, 80) + passage]
    kinds = kinds_of(spark, texts)
    text, first, last, _, mixed = kinds.runs(texts, LEAST, False)
    starts = np.append(0, np.cumsum([len(own) for own in texts]))
    sizes = {i: (last - first + 1)[(text == i) & ~mixed].tolist() for i in range(5)}
    assert sizes[0] == sizes[2] == [3000 - LEAST + 1] and sizes[1] == []
    assert len(sizes[3]) == len(sizes[4]) == 1 and sizes[3] == sizes[4] and sizes[3][0] > 2000 - 3 * LEAST
    assert (first[text == 2] - starts[2]).tolist() == [0] and mixed[text >= 3].sum() <= 8
    assert len(kinds_of(spark, texts, 1).runs(texts, LEAST, True)[0]) == len(text)  # crowded ones, too


def shards_of(docs, texts):
    """All runs as if their hashes were mixed, by shard."""
    every = b"\xff" * (1 << 17)
    batch = pd.DataFrame({"doc": docs, "text_hash": np.arange(len(docs)), "data": texts})
    return pd.concat(suffix_dedup._run_maker(Sent((20, every, every, b"")), LEAST, 4)([batch]))


def test_strings_that_share_only_what_is_hashed_are_not_sorted(monkeypatch):
    draw = random.Random(6)
    common = [random_text(draw, 20) for _ in range(5)]
    texts = [b"".join(random_text(draw, 100) + own for own in common) for _ in range(50)]

    def fail(*_):
        raise AssertionError("sorted")

    monkeypatch.setattr(suffix_dedup, "suffixes", fail)
    assert list(suffix_dedup._sorter(LEAST, 1 << 20, 4)([shards_of(range(50), texts)])) == []
    texts[7] = texts[7][:200] + texts[3][100:149] + texts[7][200:]  # a byte less than a window
    with pytest.raises(AssertionError, match="sorted"):
        list(suffix_dedup._sorter(LEAST, 1 << 20, 4)([shards_of(range(50), texts)]))


@pytest.mark.parametrize("seed", range(20))
def test_strings_with_windows_in_common_are_alike(seed):
    """Of strings with a common k-mer, of a few letters so that it can come twice."""
    draw = random.Random(seed)
    letters, own = draw.choice((range(97, 99), range(97, 123))), random_text(draw, 20)
    text = lambda n: bytes(draw.choices(letters, k=n))
    beside = [text(40) for _ in range(3)]
    texts = [text(30) + draw.choice(beside)[draw.randint(0, 40) :] + own + draw.choice(beside)[: draw.randint(0, 40)] + text(30) for _ in range(60)]
    rows = shards_of(range(60), texts)
    for _, group in rows.groupby("shard"):
        shard = suffix_dedup._Shard(LEAST, 1 << 20)
        for row in group.itertuples(index=False):
            shard.add(row)
        shard._take()
        lengths = np.array(shard.windows) + LEAST - 1
        alike = shard._alike(lengths, np.array(shard.hashes, np.uint64))
        strings = [string for _, string in shard.known]
        holders = {}
        for i, string in enumerate(strings):
            for at in range(len(string) - LEAST + 1):
                holders.setdefault(string[at : at + LEAST], set()).add(i)
        assert all(alike[i] for own in holders.values() if len(own) > 1 for i in own)


def test_spans_are_packed_by_parts_and_joined_by_texts(monkeypatch):
    """Many spans are few rows, whatever has been packed with them; of each text those that meet are one."""
    monkeypatch.setattr(suffix_dedup, "PACKED", 500)
    draw = np.random.default_rng(2)
    doc, text = draw.integers(-3, 3, 4000), draw.choice(np.array([-(2**63), -5, 0, 7, 2**63 - 1]), 4000)
    start = draw.integers(0, 3000, 4000)
    spans = (doc, text, start, start + draw.integers(1, 20, 4000))
    packed = list(suffix_dedup._pack_spans([tuple(x[i : i + 100] for x in spans) for i in range(0, 4000, 100)], 8))
    assert all(len(own) <= 5 and own["part"].is_monotonic_increasing for own in packed) and len(packed) > 5
    rows = pd.concat(packed).sort_values("part", kind="stable")
    found = {(row.doc, row.text_hash): np.frombuffer(row.spans, "<i8").reshape(-1, 2).tolist() for own in suffix_dedup._span_merger([rows]) for row in own.itertuples()}
    expected = {}
    for d, t, a, b in sorted(zip(*[x.tolist() for x in spans], strict=True)):
        own = expected.setdefault((d, t), [])
        if own and a <= own[-1][1]:
            own[-1][1] = max(own[-1][1], b)
        else:
            own.append([a, b])
    assert found == expected
