import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lectern.llm.queries import ORACLES, QUERIES
from oracle import connect, mismatch


@pytest.mark.parametrize("key", ORACLES)
def test_query_equals_oracle(spark, sf_dir, key):
    frame = QUERIES[key](spark, sf_dir)
    plan = frame._jdf.queryExecution().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert mismatch(connect(sf_dir), frame, ORACLES[key]) is None


def test_every_operator_is_registered():
    names = entry.queries()
    numbers = sorted(int(re.match(r"op(\d+)_", key)[1]) for key in names if key.startswith("op"))
    assert numbers == list(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert entry.oracle_sql().keys() <= names.keys()
