import random

import pytest
from pyspark.sql import types as T

#: Columns of documents, then others whose names the operators use inside.
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[
            T.StructField(name, T.StringType())
            for name in ("key", "value", "row", "copy", "place", "kept", "host", "whole", "fingerprint", "part", "n_words", "ids")
        ],
    ]
)
PAGES = T.StructType(
    [T.StructField("page_id", T.LongType())] + [T.StructField(n, T.StringType()) for n in ("url", "html", "host", "tree", "text")]
)
LABELS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.LongType()), T.StructField("toxic", T.LongType()), T.StructField("key", T.StringType())]
)


def odd_texts():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(draw.randint(1, 7)))
    prose = [" ".join(word() for _ in range(n)) for n in (3, 60, 200, 61, 90)]
    long = " ".join(word() for _ in range(40_000))
    return [
        None,
        "",
        " \t\n\x0b\f\r ",
        "a",
        "é",
        "𝄞 ünïcode ✓ текст   non breaking",
        "1 2 3 4 5 6 7 8 9 10",
        "one two",
        "one two three",
        *prose,
        prose[1],
        prose[1] + " zz",
        long,
        "x" * 30_000,
        "the same line\nthe same line\n\n \nthe same line \nother",
        "ONE two ONE two ONE two ONE",
        "mail a.b@c.de, a@b@c.org x@y 10.0.0.256 10.0.0.1.2 0001.2.3.4 +1 (988) 555-2485 4111 1111 1111 1111",
        "<|endoftext|> is special",
        "%%% ### $$$ &&& " * 30,
    ]


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with everything that can go wrong in a row: NULLs, empty and long texts, repeated rows, equal keys."""
    rows = []
    for i, text in enumerate(odd_texts()):
        lang = (None, "en", "fr")[i % 3]
        rows.append((i * 7 - 10, text, lang, (None, "s1", "s2", "")[i % 4], None if text is None else len(text)))
    rows.append(rows[9])
    rows.append((None, "a text without a key of its own", "en", None, 31))
    rows.append((None, None, None, None, None))
    rows.append((4, "another text under a key that is taken", "en", "s1", 38))
    return rows


def _write(spark, folder, rows, pages, labels):
    extra = tuple("clash" for _ in range(12))
    frame = spark.createDataFrame([(*row, *extra) for row in rows], DOCUMENTS)
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(pages, PAGES).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    targets = [(row[0], row[1], "clash") for row in rows[4::3]]
    spark.createDataFrame(targets, "item_id bigint, text string, pos string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd_dir(spark, odd_rows, tmp_path_factory):
    pages = [
        (1, None, None, "h", "t", "x"),
        (2, "not a url", "", "h", "t", "x"),
        (3, "http://A.example/x", "plain text", "h", "t", "x"),
        (3, "http://A.example/x", "plain text", "h", "t", "x"),
        (None, "http://a.example:80", "<p>one<p>two" + "<div>" * 3000 + "deep", "h", "t", "x"),
        (4, "http://a.example", "<a href=\"unclosed>" + "<b>x " * 2000, "h", "t", "x"),
    ]
    labels = [(row[0], 1, i % 2, "clash") for i, row in enumerate(odd_rows)] + [(None, 0, None, "clash"), (999, 1, 7, "clash")]
    return _write(spark, tmp_path_factory.mktemp("odd"), odd_rows, pages, labels)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return _write(spark, tmp_path_factory.mktemp("empty"), [], [], [])
