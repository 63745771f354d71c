"""Every registered query against its SQL twin, and the shape of the plans."""

import math
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from testbed.catalog import QUERIES
from testbed.derive import GIVEN
from testbed.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLE[name])
    places = {column[0]: i for i, column in enumerate(cursor.description)}
    assert columns == sorted(places)
    expected = Counter(tuple(plain(row[places[c]]) for c in columns) for row in cursor.fetchall())
    found = Counter(tuple(plain(row[c]) for c in columns) for row in result.collect())
    assert sum(found.values()) > 0
    assert found == expected


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_scale(spark, without_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search("Cartesian|NestedLoop|Python|Broadcast", text)


def test_conform_needs_no_shuffle(spark):
    for name in ("event_conform", "event_participant"):
        assert "Exchange" not in plan(QUERIES[name](spark, SF_DIR))


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1000
