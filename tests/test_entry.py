import duckdb
import pytest

import __spark_entry__ as contract

SMALL = "/root/testdata/sf0.001"


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["qid", "document_ids", "sources", "context_chars"]
    assert found.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["lexical_topk", "extract_sections", "cost_analysis", "split_stratified", "run_experiment"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    found = contract.queries()[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=key) == sorted(cursor.fetchall(), key=key)
