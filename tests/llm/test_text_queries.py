"""All registered text queries: against SQL, on odd rows, and on tables without rows."""

import compare
import pytest

import corpus_pipeline
from meterline.llm.queries import oracle_sql, queries

PER_DOCUMENT = [n for n in queries() if n.split("_")[0] not in ("op3", "op7", "op8")]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    found = compare.spark_rows(queries()[name](spark, sf_dir))
    assert found[1]
    assert found == compare.oracle_rows(compare.connect(sf_dir), oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_odd_rows_equal_sql(spark, odd_dir, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd_dir}/{table}.parquet/*.parquet'")
    assert compare.spark_rows(queries()[name](spark, odd_dir)) == compare.oracle_rows(db, oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(PER_DOCUMENT))
def test_odd_rows_give_a_row_each(spark, odd_dir, odd_rows, name):
    ids = [row["doc_id"] for row in queries()[name](spark, odd_dir).collect()]
    key = lambda x: (x is not None, x)
    assert sorted(ids, key=key) == sorted((row[0] for row in odd_rows), key=key)


def test_odd_pages_give_a_row_each(spark, odd_dir):
    rows = queries()["op3_wrapper_text"](spark, odd_dir).collect()
    assert len(rows) == 6
    assert all(row["n_chars"] == len(row["text"]) for row in rows)
    assert sorted(row["text"] for row in rows)[:2] == ["", ""]


@pytest.mark.parametrize("name", sorted(queries()))
def test_tables_without_rows(spark, empty_dir, name):
    assert queries()[name](spark, empty_dir).collect() == []


def test_pipeline_without_rows(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def test_pipeline_on_odd_rows_keeps_every_column(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, odd_dir)
        assert found.dtypes == docs.dtypes
        assert {row["kept"] for row in found.collect()} <= {"clash"}
