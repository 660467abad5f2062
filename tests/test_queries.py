"""Every named query against DuckDB, over the whole small tables."""

import pytest

import __spark_entry__ as entry
from sqlyard.plans import catalog, duck_sql
from tests.oracle_check import _sorted_rows, compare, duck


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() == duck_sql.QUERIES.keys()
    assert catalog.QUERIES.items() <= entry.queries().items()
    assert duck_sql.QUERIES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, sf, catalog.QUERIES[name], duck_sql.QUERIES[name]) == []


def test_entry(spark):
    assert {r["model"] for r in entry.entry(spark).collect()} == {"base", "tuned"}


def test_the_check_sees_differences(spark, con, sf):
    query = entry.queries()["exact_match"]
    sql = entry.oracle_sql()["exact_match"]
    assert compare(spark, con, sf, query, f"SELECT * REPLACE (NOT exact_match AS exact_match) FROM ({sql})")
    assert compare(spark, con, sf, query, f"SELECT * FROM ({sql}) LIMIT 10")
    assert compare(spark, con, sf, query, f"SELECT * RENAME (exact_match AS x) FROM ({sql})")
    assert _sorted_rows(["b", "a"], [(1, 2)]) == _sorted_rows(["a", "b"], [(2, 1)])


TABLES = ("orders", "lineitem", "events", "documents", "benchmark", "region", "nation", "customer", "supplier")


@pytest.fixture(scope="module")
def part_files(spark, sf, tmp_path_factory):
    """The tables stored as large ones are: folders of several part files."""
    folder = tmp_path_factory.mktemp("parts")
    for name in TABLES:
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return f"{folder}"


@pytest.mark.parametrize("name", ["plateau_stream", "exact_match_stream", "plateau", "exec_pairs", "eval_summary", "bleu_text", "first_examples"])
def test_part_files(spark, con, part_files, name):
    assert compare(spark, con, part_files, catalog.QUERIES[name], duck_sql.QUERIES[name]) == []


def test_document_stream_is_shared_among_tasks(spark, tmp_path):
    """Documents in one file are cleaned by several tasks, each of which writes its own rows."""
    rows = spark.createDataFrame([(i, "SELECT 1;") for i in range(50)], "doc_id long, text string").coalesce(1)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would join so few rows
    try:
        found = catalog.exact_match_stream(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found.count() == 50 and len(found.inputFiles()) > 1
