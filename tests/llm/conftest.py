import pytest

from lectern.llm.queries import QUERIES


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """All documents, as rows for a brute force."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


@pytest.fixture(scope="session")
def answer(spark, sf_dir):
    return lambda key: QUERIES[key](spark, sf_dir).collect()
