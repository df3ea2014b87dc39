"""Operators against plain Python on small inputs."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import class_model, crf, edit_fingerprint, golay, language, mixing, packing, personal_data, simhash, toxicity
from meterline.llm import wrapper_induction
from meterline.llm.components import components
from meterline.llm.markup import article_blocks, parse
from meterline.llm.queries import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return {row[0]: row[1:] for row in rows}


# --- 1 edit fingerprints


def _plain_walk(text):
    """The fingerprint by its definition, one step and one character at a time."""
    bits = []
    codes = [ord(c) for c in text] + [0x110000] * edit_fingerprint.CONTEXT
    wrap = 0xFFFFFFFF
    for walk in range(edit_fingerprint.WALKS):
        sampled = edit_fingerprint._Sampled(walk)
        own = [0] * edit_fingerprint.SLOTS
        at = step = 0
        while at < len(text):
            emitted = codes[at] * 0x01000193 & wrap
            for k in range(1, edit_fingerprint.CONTEXT):
                emitted = (emitted + codes[at + k]) * (0x01000193 + 2 * k) & wrap
            emitted = int(edit_fingerprint._mix(np.array([emitted], np.uint32))[0])
            sampled.up_to(step // 4096 * 4096 + 4096)
            for slot in sampled.at.get(step, []):
                key = (slot * 0x9E3779B1 + step * 0x85EBCA77) & wrap
                own[slot] = int(edit_fingerprint._mix(np.array([emitted ^ key], np.uint32))[0]) >> 31
            kind = ((codes[at] * 0x9E3779B1 & wrap) >> 20) % 255
            at += int(edit_fingerprint._moves(walk, step // 4096)[step % 4096, kind])
            step += 1
        bits += own
    return np.packbits(np.array(bits, np.uint8))


def test_fingerprints_equal_the_walk_by_single_steps():
    texts = ["", "a", "ab", "é𝄞x", "hello world " * 20, "z" * 500, "hello world " * 20]
    found = edit_fingerprint.fingerprint_bits(texts)
    for text, bits in zip(texts, found, strict=True):
        assert (bits == _plain_walk(text)).all()


def test_following_rows_and_edited_texts(spark, docs):
    rows = queries()["op1_edit_fingerprints"](spark, SF).collect()
    ids = sorted(docs)
    following = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    own = {row["doc_id"]: row["fingerprint"] for row in rows}
    assert len(rows) == len(docs)
    for row in rows:
        text, after = docs[row["doc_id"]][0], docs[following[row["doc_id"]]][0]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        pair = (bytes.fromhex(own[i]) for i in (row["doc_id"], following[row["doc_id"]]))
        differing = bytes(a ^ b for a, b in zip(*pair, strict=True))
        width = edit_fingerprint.SLOTS // 8
        least = min(int.from_bytes(differing[i : i + width]).bit_count() for i in range(0, len(differing), width))
        assert row["near_next"] == pytest.approx(max(0, 1 - 2 * least / edit_fingerprint.SLOTS))


def test_likeness_falls_with_the_share_that_was_edited():
    draw = random.Random(1)
    text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(4000))
    other = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(4000))
    texts = [text, text[:2000] + "inserted" + text[2000:], text[:3000] + other[:1000], text[:1000] + other[:3000], other]
    bits = edit_fingerprint.fingerprint_bits(texts)
    near = [float(edit_fingerprint.likeness_of(bits[:1], bits[i : i + 1])[0]) for i in range(5)]
    assert near[0] == 1
    assert near == sorted(near, reverse=True)
    assert near[1] > 0.6 and near[4] < 0.15


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    draw = random.Random(2)
    for _ in range(60):
        a, b = ("".join(draw.choice("abc") for _ in range(draw.randint(0, 80))) for _ in range(2))
        assert edit_fingerprint.edit_distance(a, b) == plain(a, b)


def test_near_duplicates_by_edits(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(5))
    rows = []
    for group in range(12):
        words = [word() for _ in range(150)]
        for copy in range(3):
            changed = list(words)
            for _ in range(copy * 2):
                changed[draw.randrange(150)] = word()
            rows.append((group * 10 + copy, " ".join(changed)))
    rows += [(500, rows[0][1]), (501, None), (502, "")]
    found = edit_fingerprint.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    component = {row["doc_id"]: row["component"] for row in found}
    assert len(found) == len(rows)
    assert all(component[i] == i // 10 * 10 for i in component if i < 500)
    assert (component[500], component[501], component[502]) == (0, 501, 501)


# --- components


def test_components_equal_union_find(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    edges += [(5, 5), (None, 3), edges[0]]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    links = spark.createDataFrame(edges, "a long, b long")
    found = {row["node"]: row["root"] for row in components(links, "a", "b").collect()}
    assert found == {x: root(x) for x in parent}


# --- 5 simhash


def _plain_simhash(text):
    import xxhash

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_classes_equal_all_pairs(spark, docs):
    rows = queries()["op5_simhash_golay"](spark, SF).collect()
    prints = {row["doc_id"]: int(row["fingerprint"], 16) for row in rows}
    assert prints == {i: _plain_simhash(row[0]) for i, row in docs.items()}
    values = np.array([prints[i] for i in sorted(prints)], np.uint64)
    ids, parent = sorted(prints), {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ values[k]) <= 2).tolist():
            a, b = root(i), root(ids[j])
            parent[max(a, b)] = min(a, b)
    assert {row["doc_id"]: row["component_id"] for row in rows} == {i: root(i) for i in ids}


def test_links_of_crowded_and_of_scattered_fingerprints(spark):
    draw = random.Random(6)
    centre = draw.getrandbits(64)
    values = {centre} | {centre ^ 1 << a ^ 1 << b for a in range(64) for b in range(a)}
    for _ in range(300):
        base = draw.getrandbits(64)
        values |= {base, base ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    linked = {}
    for row in components(simhash.links(nodes), "node", "other").collect():
        linked[row["node"] % (1 << 64)] = row["root"]
    array, parent = np.array(values, np.uint64), list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array[:k] ^ array[k]) <= 2).tolist():
            a, b = root(k), root(j)
            parent[max(a, b)] = min(a, b)
    groups = {}
    for k, value in enumerate(values):
        groups.setdefault(root(k), set()).add(value)
    found = {}
    for value in values:
        found.setdefault(linked.get(value, ("alone", value)), set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_golay_words_one_bit_apart_share_a_key():
    draw = np.random.RandomState(7)
    words = draw.randint(0, 1 << 23, 3000).astype(np.int64)
    others = words ^ (1 << draw.randint(0, 23, 3000))
    sets = []
    for group in (words, others):
        own = [set() for _ in group]
        for place, key in zip(*golay.keys(group), strict=True):
            own[place].add(int(key))
        sets.append(own)
    assert all(a & b for a, b in zip(*sets, strict=True))
    assert max(map(len, sets[0])) == 6


def test_rare_kinds_are_learnt_and_the_field_never_vanishes(spark):
    """Three documents of 20,000 hold a finding, and a corpus without any."""
    rows = [(i, f"in {1900 + i % 120} there were {i} of them at {i % 24}:30") for i in range(20_000)]
    rare = [(20_000, "call +1 (988) 555-2485 now"), (20_001, "card 4111 1111 1111 1111 expired"), (20_002, "write a.b@c.org")]
    other = "call (988) 555-2485 or use 4111.1111.1111.1111 since 1999"
    for own in (rows + rare, rows):
        model = personal_data.fitted(spark.createDataFrame(own, "doc_id long, text string"), "doc_id", "text")
        (_, spans), (_, none) = personal_data.all_spans([other, rows[77][1]], model)
        assert [kind for kind, _, _ in spans] == ["card", "phone"] and none == []
        assert personal_data.redact(other, spans) == "call [PHONE] or use [CARD] since 1999"


def test_all_kinds_are_sampled(spark):
    rows = [(i, f"number {i}") for i in range(5_000)] + [(9_000, "see 10.0.0.1"), (9_001, "card 4111 1111 1111 1111")]
    texts = personal_data.training_texts(spark.createDataFrame(rows * 3, "doc_id long, text string"), "doc_id", "text")
    assert {"see 10.0.0.1", "card 4111 1111 1111 1111"} <= set(texts) and len(texts) <= personal_data.TRAINING_DOCS


# --- 7 packing


def test_packing_holds_every_token_once(spark, docs):
    from collections import defaultdict

    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries()["op7_bounded_packing"](spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append(row)
    assert set(pieces) == set(docs)
    for doc, own in pieces.items():
        ids = np.array([*tokenizer.encode(docs[doc][0], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for row in sorted(own, key=lambda r: r["start"]):
            assert row["start"] == at and row["doc_tokens"] == len(ids)
            at += row["length"]
            assert row["ids_crc32"] == zlib.crc32(ids[row["start"] : at].tobytes())
        assert at == len(ids)
    lengths = []
    for own in sequences.values():
        at = 0
        for row in sorted(own, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        lengths.append(at)
    assert max(lengths) == 2048
    assert sum(length < 2048 for length in lengths) <= 1


def test_fast_ids_are_the_tokenizers_ids(odd_rows):
    fast, slow = packing.encoder(), packing.encoder(ranks=None)
    texts = [row[1] or "" for row in odd_rows] + ["don't we'll  x\n\n\ny   ½² ĳŉ ­", "a b​", "\x85\x1c", "".join(map(chr, range(32, 0x250)))]
    for text in texts:
        assert fast(text).tolist() == slow(text).tolist()


# --- 6 personal data


def _plain_base(text):
    spans = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and personal_data.luhn(digits):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def test_base_spans_equal_the_patterns(docs, odd_rows):
    draw = random.Random(8)
    noise = ["".join(draw.choice("a@.1234567890-+() 4_") for _ in range(60)) for _ in range(4000)]
    edges = ["a@b.c_x@d.e", "a@@b.c", "@b.c", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "0" * 5000 + ".1.1.1"]
    for text in [row[0] for row in docs.values()] + [row[1] or "" for row in odd_rows] + noise + edges:
        if "0" * 5000 not in text:
            assert personal_data.base_spans(text) == _plain_base(text), text
    assert personal_data.base_spans(edges[-1]) == [("ip", 0, 5006)]


def test_spans_hold_the_base_and_leave_clean_texts_alone(spark, docs):
    rows = {row["doc_id"]: row for row in queries()["op6_crf_personal_data"](spark, SF).collect()}
    assert len(rows) == len(docs)
    added = 0
    for doc, row in rows.items():
        base = _plain_base(docs[doc][0])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in personal_data.KINDS] == [sum(s[0] == kind for s in base) for kind in personal_data.KINDS]
        spans = [s for s in row["spans"].split(",") if s]
        assert set(filter(None, joined.split(","))) <= set(spans)
        if not re.search("[0-9@]", docs[doc][0]):
            assert not spans
        added += len(spans) - len(base)
    assert added <= 0.02 * len(docs)


def test_field_finds_spellings_that_the_patterns_miss(spark, docs):
    table = spark.createDataFrame([(i, row[0]) for i, row in docs.items()], "doc_id long, text string")
    model = personal_data.fitted(table, "doc_id", "text")
    text = "Call (212) 555-0143 or 212-555-0187 soon, card 4111.1111.1111.1111 ends. Version 4.0. Order 7 of 12."
    (base, spans), *_ = personal_data.all_spans([text], model)
    assert base == []
    found = {(kind, text[a:b]) for kind, a, b in spans}
    assert {("phone", "(212) 555-0143"), ("phone", "212-555-0187"), ("card", "4111.1111.1111.1111")} <= found
    assert not any("4.0" in value or value in ("7", "12") for _, value in found)
    assert personal_data.redact(text, spans).startswith("Call [PHONE] or [PHONE] soon, card [CARD]")


def test_viterbi_equals_all_paths():
    draw = np.random.RandomState(9)
    model = crf.Model(draw.randn(20, 3), draw.randn(3, 3), draw.randn(3))
    sequences = [draw.randint(0, 20, (n, 2)) for n in (1, 2, 5, 6)]
    import itertools

    for sequence, labels in zip(sequences, crf.decode(model, sequences), strict=True):
        def value(path, sequence=sequence):
            total = model.first[path[0]] + sum(model.moves[a, b] for a, b in zip(path, path[1:], strict=False))
            return total + sum(model.unary[f].sum(axis=0)[y] for f, y in zip(sequence, path, strict=True))

        best = max(itertools.product(range(3), repeat=len(sequence)), key=value)
        assert value(tuple(labels)) == pytest.approx(value(best))


# --- 8 mixing


def test_poisson_thresholds(spark):
    row = spark.sql("SELECT 2.5D AS rate").select(mixing.thresholds(F.col("rate")).alias("s")).first()
    expected = np.cumsum([math.exp(-2.5) * 2.5**k / math.factorial(k) for k in range(len(row["s"]))])
    assert np.allclose(row["s"], expected) and row["s"][-1] > 1 - 1e-14


def test_mixing_meets_its_weights_and_order(spark):
    rows = [(i, "big" if i % 10 else ("small" if i % 20 else None), "t") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, copy string")
    mixed = mixing.mix(docs, "source", {"big": 0.5, "small": 0.25, None: 0.25})
    table = mixed.select("row.*", F.col("copy").alias("number"), "place").toPandas()
    share = table.groupby("source", dropna=False).size() / 20_000
    assert abs(share["big"] - 0.5) < 0.03 and abs(share["small"] - 0.25) < 0.03 and abs(share[share.index.isna()].iloc[0] - 0.25) < 0.03
    assert set(table["copy"]) == {"t"}
    assert table.groupby(["doc_id", "number"]).size().max() == 1
    again = mixing.mix(docs.repartition(5), "source", {"big": 0.5, "small": 0.25, None: 0.25})
    assert sorted(again.select("place").toPandas()["place"]) == sorted(table["place"])


def test_rows_of_one_key_draw_by_themselves(spark):
    """1,000 different rows without key, and 1,000 equal ones: both keep their rate and reach all partitions."""
    rows = [(None, "a", f"text {i}") for i in range(1_000)] + [(7, "b", "same")] * 1_000 + [(i, "c", "t") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(docs, "source", {"a": 0.16, "b": 0.16, "c": 0.68})
    found = mixed.withColumn("part", F.spark_partition_id()).select("row.*", "copy", "part").toPandas()
    for source in "ab":
        own = found[found["source"] == source]
        assert abs(len(own) - 800) < 5 * math.sqrt(800)
        assert own["part"].nunique() == 8 and own["part"].value_counts().max() < 0.3 * len(own)
        taken = (own["copy"] == 1).sum()  # of 1,000 Poisson draws with mean 0.8
        assert abs(taken - 1_000 * (1 - math.exp(-0.8))) < 5 * math.sqrt(250)
    again = mixing.mix(docs.repartition(3), "source", {"a": 0.16, "b": 0.16, "c": 0.68})
    assert sorted(row["place"] for row in again.collect()) == sorted(row["place"] for row in mixed.collect())


def test_repeated_rows_unfold_in_steps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 7)
    docs = spark.createDataFrame([(1, "x")] * 100 + [(2, "y")], "doc_id long, source string")
    found = sorted(row["identity"].split(":")[1] for row in mixing.numbered_rows(docs).where("row.doc_id = 1").collect())
    assert found == sorted(str(i) for i in range(1, 101))


def test_rare_source_beside_millions_of_rows(spark):
    source = F.when(F.col("id") > 2, (F.col("id") % 10).cast("string")).alias("source")
    docs = spark.range(18_000_000).select(F.col("id").alias("doc_id"), source)
    sizes = [3, *[row["count"] for row in docs.where("source IS NOT NULL").groupBy("source").count().collect()]]
    rate = math.sqrt(3) / sum(map(math.sqrt, sizes)) * 18_000_000 / 3
    assert rate > 700
    mixed = mixing.mix(docs, "source").where("row.source IS NULL")
    rows = mixed.groupBy("row.doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("copy").alias("numbers"), F.max("copy").alias("most")).collect()
    assert len(rows) == 3
    assert all(row["n"] == row["numbers"] == row["most"] and abs(row["n"] - rate) < 6 * math.sqrt(rate) for row in rows)


def test_large_rates_have_the_poisson_distribution(spark):
    sums = mixing.thresholds(F.lit(690.0))
    table = spark.range(1).select(sums.alias("sums")).crossJoin(spark.range(4_000))
    drawn = mixing.drawn_copies(F.col("sums"), F.lit(3).cast("bigint"), "s", F.col("id"), mixing.unit_hash(F.lit("s"), F.col("id")))
    counts = np.array([row["n"] for row in table.select(drawn.alias("n")).collect()])
    assert abs(counts.mean() - 2_070) < 4 * math.sqrt(2_070 / 4_000)
    assert abs(counts.var() / 2_070 - 1) < 0.1


# --- 3 pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body class="main">
<header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice">We use cookies</div>
<div class="sidebar"><p>Side</p></div><article><header><h2>Title &amp; more</h2><span>by me</span></header>
<p>First  <b>bold</b>
text&nbsp;here.<p>Second &#233;t&eacute;<br>line<div class="ad-box">Buy</div><form><input value=x><label>Name</label></form>
<ul><li>one<li>two</ul><!-- hidden --><div style="display: none">gone</div><section id="comments"><p>Nice!</p></section></article>
<aside>More</aside><footer>&copy; us</footer></body></html>"""


def test_article_of_a_page():
    assert article_blocks(parse(PAGE), {}) == ["Title & more", "First bold text here.", "Second été line", "one", "two"]


def test_articles_in_other_layouts():
    comments = '<div id="comments"><article class="comment"><p>A long comment of a reader, longer than the article itself is.</p></article></div>'
    layouts = {
        f'<body><div class="page with-sidebar"><article><p>Text one.</p><p>Two.</p>{comments}</article><div class="sidebar">Side</div></div></body>': ["Text one.", "Two."],
        f'<body><main><h1>Head</h1><p>Text.</p><div class="newsletter-signup">Join</div></main>{comments}</body>': ["Head", "Text."],
        f'<body><div class="topNav">Menu</div><div class="post-content"><h1>Head</h1><p>Text.</p></div>{comments}<div id="footer">F</div></body>': ["Head", "Text."],
        '<body><nav>Menu</nav><p>Just text</p><footer>F</footer></body>': ["Just text"],
        '<body><section class="teasers"><article class="teaser"><p>A teaser that is longer than the text by far.</p></article></section><article><p>Text.</p></article></body>': ["Text."],
        '<article><h1>T</h1><table><tr><td>a<td>b<tr><td>c</table><pre>x\n  y</pre><figure><img alt=i><figcaption>Cap</figcaption></figure><blockquote>Q</blockquote></article>': ["T", "a", "b", "c", "x y", "Cap", "Q"],
        '<article><div role="alert">Notice</div><p hidden>no</p><p>Yes<script>x</script> it is<noscript>n</noscript></p><button>B</button><select><option>o</select></article>': ["Yes it is"],
    }
    for source, blocks in layouts.items():
        assert article_blocks(parse(source), set()) == blocks, source


def test_broken_pages():
    assert article_blocks(parse("a &am"), {}) == ["a &am"]
    assert article_blocks(parse("<p>x</p></div></p>y<b>z"), {}) == ["x", "yz"]
    assert article_blocks(parse("<script>never closed <p>x"), {}) == []
    assert article_blocks(parse("a < b <3 <"), {}) == ["a < b <3 <"]


def test_template_of_a_host(spark):
    """Pages without any telling tag or name: only what changes from page to page is content."""
    draw = random.Random(10)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    pages, expected = [], {}
    for i in range(150):
        title = f"Title {word()} {i}"
        own = [" ".join(word() for _ in range(20)) + f" {i}" for _ in range(draw.randint(1, 5))]
        source = (
            "<body><div class='x1'><a>Home</a> <a>News</a> <a>Contact us</a></div>"
            f"<div class='x2'><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in own)}</div>"
            "<div class='x3'><p>All rights of this page are ours.</p></div></body>"
        )
        pages.append((i, "http://one.example/" + word(), source))
        expected[i] = "\n\n".join([title, *own])
    pages.append((1000, "http://two.example/", pages[0][2]))
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {row["page_id"]: row["text"] for row in wrapper_induction.extract_text(table, "page_id", "url", "html").collect()}
    assert {i: found[i] for i in expected} == expected
    assert found[1000].startswith("Home News Contact us\n\n")


def test_articles_of_the_given_pages(spark):
    rows = queries()["op3_wrapper_text"](spark, SF).collect()
    sources = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    for row in rows:
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", sources[row["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>?", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", article)]
        assert row["text"] == "\n\n".join(filter(None, blocks))
    assert len(rows) == len(sources)


@pytest.mark.parametrize("most", [12, 150])
def test_a_notice_without_class_is_template_wherever_it_stands(spark, most):
    """64 pages of 3 to ``most`` own paragraphs, one equal notice at the end and one in the middle, none with a class."""
    draw = random.Random(most)
    words = lambda: " ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(9))
    pages, own = [], {}
    for i in range(64):
        paragraphs = [words() for _ in range(draw.randint(3, most))]
        own[i] = "\n\n".join(paragraphs)
        middle = len(paragraphs) // 2
        shown = [*paragraphs[:middle], "Read our terms before you go on.", *paragraphs[middle:], "All rights are reserved by the owners."]
        body = "".join(f"<p>{p}</p>" for p in shown)
        pages.append((i, f"http://h.example/{i}", f"<html><body><article>{body}</article></body></html>"))
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {row["page_id"]: row["text"] for row in wrapper_induction.extract_text(table, "page_id", "url", "html").collect()}
    assert found == own


def test_alignment_is_the_best_one():
    draw = random.Random(11)

    def tree(depth):
        children = [tree(depth - 1) for _ in range(draw.randint(0, 3))] if depth else []
        return wrapper_induction.Tree(draw.choice("ab"), 1, {draw.randrange(2): 1}, children)

    def plain(a, b):
        """Most matched nodes below two nodes, all subsets tried by recursion over the lists of children."""
        if a.label != b.label:
            return 0

        def lists(x, y):
            if not x or not y:
                return 0
            here = plain(x[0], y[0])
            return max(here + lists(x[1:], y[1:]) if here else 0, lists(x[1:], y), lists(x, y[1:]))

        return 1 + lists(a.children, b.children)

    def count(pairs):
        return sum(1 + count(wrapper_induction.match(a.children, b.children)) for a, b in pairs)

    close = 0
    for _ in range(200):
        a, b = tree(3), tree(3)
        if a.label == b.label:
            best, own = plain(a, b) - 1, count(wrapper_induction.match(a.children, b.children))
            assert own <= best
            close += own >= 0.7 * best
        else:
            close += 1
    assert close >= 190


def test_copies_of_a_page_count_as_often_as_they_occur():
    draw = random.Random(3)
    page = lambda n: f"<div class=top>menu</div><article><p>{' '.join(draw.choices('abcde', k=n))}</p><p>x</p></article>"
    forms = [wrapper_induction.written_form(wrapper_induction.tree_of(wrapper_induction.parse(page(n)))) for n in (3, 4, 5)]
    one_by_one = wrapper_induction._merge_chunk([(form, 1) for form in sorted(forms) for _ in range(7)])
    assert wrapper_induction._merge_chunk([(form, 7) for form in sorted(forms)]) == one_by_one
    assert wrapper_induction.read_form(one_by_one).support == 21


# --- 4 class model


def _tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


@pytest.fixture(scope="module")
def scored(spark):
    return queries()["op4_brown_classes"](spark, SF).collect()


def test_base_score_and_counts(docs, scored):
    training = Counter()
    for doc, row in docs.items():
        if zlib.crc32(str(doc).encode()) % 10:
            training.update(_tokens(row[0]))
    total, distinct = sum(training.values()), len(training)
    for row in scored:
        found = _tokens(docs[row["doc_id"]][0])
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 10 == 0)
        assert (row["n_tokens"], row["n_known"]) == (len(found), sum(t in training for t in found))
        assert row["train_tokens"] == total
        base = sum(math.log10((training[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in found)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)


def test_classes_predict_better_than_single_words(scored):
    held_out = [row for row in scored if row["held_out"]]
    assert sum(row["score"] for row in held_out) > sum(row["base_score"] for row in held_out)
    assert all(row["score"] < 0 for row in scored)


def test_probabilities_of_the_next_word_sum_to_one(spark, docs, monkeypatch):
    monkeypatch.setattr(class_model, "ITEMS", 300)
    monkeypatch.setattr(class_model, "HEAD", 1000)
    rows = spark.createDataFrame([(i, row[0]) for i, row in list(docs.items())[:200]], "doc_id long, text string")
    counts = class_model.word_counts(rows).persist()
    known = class_model.vocabulary(counts)
    classes, table = class_model.exchange(class_model.item_bigrams(rows, known), known)
    scorer = class_model.Scorer(known, classes, table)
    words = [bytes(row["word"]) for row in counts.collect() if row["word"]]
    c = {bytes(row["word"]): row["c"] for row in counts.collect()}
    _, items = known.items(words)
    moves, emitted = 10 ** scorer.moves, 10**scorer.items
    assert np.allclose(moves.sum(axis=1), 1)
    inside = np.where(known.single[items], 1.0, [(c[w] + 0.1) / (known.item_counts[i] + 0.1 * (known.item_words[i] + 1)) for w, i in zip(words, items, strict=True)])
    unseen = np.where(known.single, 0.0, 0.1 / (known.item_counts + 0.1 * (known.item_words + 1)))
    of_item = np.bincount(items, inside, len(known.item_counts)) + unseen
    of_item[1] = 1
    assert np.allclose(of_item, 1)
    of_class = np.bincount(classes, emitted * of_item, class_model.CLASSES)
    assert np.allclose(of_class[of_class > 0], 1)


def test_best_class_is_the_best_of_all(monkeypatch):
    monkeypatch.setattr(class_model, "CLASSES", 4)
    draw = np.random.RandomState(12)
    pairs = draw.randint(0, 9, (12, 12))
    classes = np.concatenate([[0], draw.randint(1, 4, 11)])

    def table(assigned):
        found = np.zeros((4, 4))
        for a in range(12):
            for b in range(12):
                found[assigned[a], assigned[b]] += pairs[a, b]
        return found

    for item in range(1, 12):
        values = []
        for to in range(1, 4):
            moved = classes.copy()
            moved[item] = to
            values.append(class_model.likelihood(table(moved)))
        before = np.bincount(classes, pairs[:, item], 4)
        after = np.bincount(classes, pairs[item], 4)
        to, gain = class_model.best_class(table(classes), classes[item], before.astype(float), after.astype(float), float(pairs[item, item]))
        assert to == 1 + int(np.argmax(values))
        assert gain == pytest.approx(max(values) - class_model.likelihood(table(classes)), abs=1e-8)


# --- 9 toxicity


def test_index_finds_the_nearest_of_all():
    draw = random.Random(13)
    vectors = []
    for _ in range(500):
        own = {draw.randrange(80): draw.random() + 0.1 for _ in range(draw.randint(1, 6))}
        norm = math.sqrt(sum(w * w for w in own.values()))
        vectors.append({t: w / norm for t, w in own.items()})
    index = toxicity.Index(vectors, 80)
    for query in vectors[::10]:
        every = sorted((-sum(w * v.get(t, 0) for t, w in query.items()) for v in vectors))[:15]
        _, cosines = index.nearest(query, 15)
        assert np.allclose(sorted(-cosines), [x for x in every if x < 0][: len(cosines)], atol=1e-5)
        assert len(cosines) == sum(x < 0 for x in every)


def test_toxic_documents_are_found(spark):
    folder = "/root/testdata/sf0.1"
    rows = {row["doc_id"]: row for row in queries()["op9_toxic_neighbours"](spark, folder).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    held_out = [(rows[i], toxic) for i, toxic in labels if rows[i]["held_out"]]
    right = sum(row["predicted"] == toxic for row, toxic in held_out) / len(held_out)
    caught = sum(row["predicted"] for row, toxic in held_out if toxic) / sum(toxic for _, toxic in held_out)
    assert right > 0.97 and caught > 0.85


# --- 10 language


def test_languages_of_held_out_documents(spark, docs):
    rows = queries()["op10_zstd_language"](spark, SF).collect()
    held_out = [row for row in rows if row["held_out"]]
    right = [row for row in held_out if row["lang_pred"] == docs[row["doc_id"]][1]]
    assert len(right) > 0.98 * len(held_out)
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_samples_have_the_smallest_hashes(spark):
    from meterline.llm.common import smallest_hashes, smallest_hashes_by

    rows = spark.range(60_000).selectExpr("id AS key", "if(id % 3 = 0, 'a', 'b') AS lang", "CAST(id % 7 AS STRING) AS text")
    sizes = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    hashed = rows.withColumn("h", F.xxhash64("lang", "key", "text"))
    for name in sizes:
        expected = sorted(row["h"] for row in hashed.where(F.col("lang") == name).collect())[:400]
        found = smallest_hashes_by(rows, "lang", 400, "key", "text").where(F.col("group") == name).collect()
        assert sorted(row["hash"] for row in found) == expected
    found = sorted(row["hash"] for row in smallest_hashes(rows, 50, "key", "text").collect())
    assert found == sorted(row[0] for row in rows.select(F.xxhash64("key", "text")).collect())[:50]


def test_a_language_of_few_texts_repeated_has_a_dictionary(spark):
    rows = [(i % 6, f"ein kurzer satz in einer sprache mit worten nummer {'abcdef'[i % 6]}", "de") for i in range(60_000)]
    rows += [(i, f"some other words of a language that has many texts {i} and more of them {i * 7}", "en") for i in range(100, 3_000)]
    docs = spark.createDataFrame(rows, "key long, text string, lang string")
    found = language.dictionaries(docs, "key", "text", "lang")
    assert set(found) == {"de", "en"} and len(found["de"]) > 100


def test_one_long_text_does_not_fill_a_dictionary(spark):
    rows = [(i, f"word{'abcdefghij'[i % 10] * 3} and so on", "en") for i in range(200)] + [(i, "zzz " * 200_000, "en") for i in (1_000, 1_001)]
    content = language.dictionaries(spark.createDataFrame(rows, "key long, text string, lang string"), "key", "text", "lang")["en"]
    assert content.count(b"word") > 100 and content.count(b"zzz") < 600


def test_whole_texts_are_compared_with_all_examples():
    draw = random.Random(17)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(1, 6))) for _ in range(3_000)]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(draw.choices(words, weights, k=draw.randint(0, 60))) for _ in range(700)]
    texts += [texts[5], texts[5] + " zzz", ""]
    frequencies = {word: draw.randint(1, 900) for word in words}
    index = toxicity.WholeIndex(texts, frequencies, 1_000)

    def unit(text):
        own = {w: (1 + math.log(n)) * (math.log(1_001 / (frequencies.get(w, 0) + 1)) + 1) for w, n in Counter(toxicity._word.findall(text)).items()}
        norm = math.sqrt(sum(x * x for x in own.values())) or 1
        return {w: x / norm for w, x in own.items()}

    units = [unit(text) for text in texts]
    for text in texts[:40] + ["", "unknownword", texts[5] + " unknownword", " ".join(words[:300])]:
        own = unit(text)
        cosines = [sum(x * other.get(w, 0) for w, x in own.items()) for other in units]
        best = sorted(cosines, reverse=True)[:15]
        found, near = index.nearest(toxicity.words_of(text), 15)
        assert np.allclose(near, [c for c in best if c > 1e-6], atol=1e-5)
        assert np.allclose([cosines[i] for i in found], near, atol=1e-5)
        assert 5 not in index.nearest(toxicity.words_of(texts[5]), 15, 5)[0]
        above = index.nearest(toxicity.words_of(text), 15, least=0.3)[1]
        assert np.allclose(above, [c for c in best if c >= 0.3], atol=1e-5)


def test_texts_far_from_all_examples_are_told_by_their_rarest_words():
    """Their frequent words are not read, and no text that is near enough is lost."""
    draw = random.Random(19)
    words = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(4_000)]
    weights = [1 / (i + 100) for i in range(len(words))]
    texts = [" ".join(draw.choices(words, weights, k=draw.randint(20, 60))) for _ in range(600)]
    index = toxicity.WholeIndex(texts, Counter(word for text in texts for word in set(text.split())), len(texts))
    queries = [" ".join(draw.choices(words, weights, k=40)) for _ in range(40)]
    # Parts of examples, from far to near.
    queries += [" ".join(text.split()[: 2 + i % 60]) for i, text in enumerate(texts[:120])]
    near = []
    for text in queries:
        examples, cosines = index.nearest(toxicity.words_of(text), 15)
        near.append(examples[cosines >= 0.8].tolist())
        assert index.nearest(toxicity.words_of(text), 15, least=0.8)[0].tolist() == near[-1]
    assert 20 < sum(map(bool, near)) < 140
    index.most = None  # reading the frequent words fails from here on
    for text, wanted in zip(queries[:40], near[:40], strict=True):
        assert not wanted and not len(index.nearest(toxicity.words_of(text), 15, least=0.8)[0])


def test_words_of_ascii_and_other_texts():
    every = "".join(map(chr, range(0x3000))) + "\u212a\u0130\U0001d400"
    for text in ("", every, every[:128], "a" + "b ".join(every[:128]), "K\u212a1x_y", "It's 3x\x1fTwo\n"):
        assert toxicity.all_words(text) == toxicity._word.findall(text.lower())
    known = {"bad": 1, "badl*": 2, "worse*": 3}
    counts = Counter({"bad": 2, "badly": 3, "worsening": 1, "worst": 4, "ba": 1, "good": 2})
    assert toxicity.counted(counts, known, toxicity.heads_of(known)) == {0: 7, 1: 2, 2: 3, 3: 1}
    assert toxicity.counted(Counter("good"), known, toxicity.heads_of(known)) == {}


def test_copies_of_toxic_examples_are_found_by_their_own_words(spark):
    """Toxic texts of words that no other has, and of ordinary words: each is its own first evidence."""
    draw = random.Random(21)
    usual = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(800)]
    clean = [" ".join(draw.choices(usual, k=80)) for _ in range(1_500)]
    marked = [" ".join(draw.choices(usual, k=70) + draw.choices(["vile", "hateful", "scum"], k=10)) for _ in range(200)]
    rare = [" ".join("".join(draw.choices("klmnopqrstuvwxyz", k=7)) for _ in range(60)) for _ in range(40)]
    ordinary = [" ".join(draw.choices(usual, k=80)) for _ in range(40)]
    texts = clean + marked + rare + ordinary
    toxic = [0] * len(clean) + [1] * (len(texts) - len(clean))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model = toxicity.fitted(docs, labels, "doc_id", "text", "toxic")
    learned = set(model.all_ids)
    for i in range(len(clean) + len(marked), len(texts)):
        if i in learned:
            score, evidence = model.score(texts[i])
            assert score >= 0.5 and evidence[0] == i
            score, evidence = model.score(texts[i] + " and more")
            assert score >= 0.5 and evidence[0] == i
    wrong = sum(model.score(text)[0] >= 0.5 for text in clean)
    assert wrong <= 5 and sum(model.score(text)[0] >= 0.5 for text in marked) >= 195


def test_labels_given_many_times_are_one_example(spark):
    docs = spark.createDataFrame([(i, f"text number {i} {'bad' if i % 5 == 0 else 'good'} word") for i in range(300)], "doc_id long, text string")
    labels = spark.range(200_000).selectExpr("id % 300 AS doc_id", "CAST(id % 5 = 0 AS int) AS toxic")
    model = toxicity.fitted(docs, labels, "doc_id", "text", "toxic")
    assert len(model.ids) > 0 and model.score("a bad word")[0] > model.score("a good word")[0]


def test_texts_without_letters_have_no_language():
    compressors = language.Compressors({"en": b"the quick brown fox " * 5, "fr": b"le renard brun rapide " * 5})
    for text in (None, "", " 12 + 3 = 15 \n", "___", "½ ² Ⅷ"):
        assert compressors.predict(text) == ("und", 0.0, True)
    assert compressors.predict("the quick brown fox")[0] == "en"
    assert compressors.predict("le renard brun")[0] == "fr"
    assert language.Compressors({}).predict("text")[0] == "und"
