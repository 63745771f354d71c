"""Registered queries against their SQL twins, and what else is registered."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from rimline.llm.registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    cursor = connection.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(columns) == sorted(result.columns)
    assert sorted(map(tuple, result.select(columns).collect())) == sorted(cursor.fetchall())


def test_each_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(QUERIES) <= set(entry_points.queries()) and "pipeline" in QUERIES
    assert corpus_pipeline.ORACLE_SQL is None
