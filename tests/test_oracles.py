import re

import pytest

import __spark_entry__ as entry
from lectern.plans.oracles import ORACLES
from lectern.plans.queries import QUERIES
from oracle import connect, mismatch


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_oracle(spark, connection, sf_dir, key):
    frame = QUERIES[key](spark, sf_dir)
    plan = frame._jdf.queryExecution().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|RoundRobinPartitioning", plan)
    assert mismatch(connection, frame, ORACLES[key]) is None


def test_queries_are_registered():
    assert entry.queries().keys() >= QUERIES.keys()
    assert entry.oracle_sql().keys() >= ORACLES.keys()


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["doc_id", "rank", "word", "tfidf"]
    assert not frame.isEmpty()
