import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from lectern.llm.line_windows import LINE_DEDUP_SQL
from lectern.llm.packing import pack_by_cost
from lectern.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_registered():
    names = [n for n in contract.queries() if n.startswith("op") and n.split("_")[0][2:].isdigit()]
    assert sorted(int(n.split("_")[0][2:]) for n in names) == list(range(1, 14))
    assert contract.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in contract.oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(LLM_ORACLES[name])
    columns = [d[0] for d in cursor.description]
    found = LLM_QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert rows(found.select(*columns)) == sorted(cursor.fetchall(), key=lambda r: tuple((v is None, v) for v in r))


def test_stages_follow_each_other(spark, docs, tmp_path):
    seen = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, frame, FOLDER).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        assert frame.columns == COLUMNS and frame.dtypes == docs.dtypes
        seen[name] = {r.doc_id: r for r in frame.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = seen["quality classifier"]
    assert np.mean([d in kept for d, good in labels.items() if good]) > 0.97 and np.mean([d not in kept for d, good in labels.items() if not good]) > 0.8
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/quality classifier/*.parquet'")
    want = {r[0]: r[4] for r in con.execute(f"SELECT doc_id, n_lines, n_removed, n_spans, text FROM ({LINE_DEDUP_SQL})").fetchall()}
    assert {d: r.text for d, r in seen["line dedup"].items()} == want
    assert all(r.n_chars == len(r.text) for r in seen["line dedup"].values())
    assert set(seen["SimHash near-dedup"]) < set(seen["line dedup"])
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaky = {d for d, r in seen["SimHash near-dedup"].items() if any(i in r.text for i in items)}
    assert set(seen["SimHash near-dedup"]) - set(seen["benchmark decontamination"]) >= leaky and len(seen["benchmark decontamination"]) >= len(seen["SimHash near-dedup"]) - len(leaky) - 1
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(seen["benchmark decontamination"])
    assert rows(corpus_pipeline.run(spark, FOLDER).groupBy("doc_id").sum("length")) == rows(pack_by_cost(frame).groupBy("doc_id").sum("length"))


def test_stages_take_odd_tables(spark, docs):
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (2, None, None, "s", None), (3, "one line of plain words", None, "s", 5), (3, "one line of plain words", None, "s", 5)],
        docs.schema,
    ).withColumns({c: F.lit(1) for c in ("fp", "node", "quality_keep", "k1", "component_id", "covered")})
    for frame in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, frame, FOLDER)
            assert found.columns == COLUMNS
            found.collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).collect()
