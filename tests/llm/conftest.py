"""Small tables for the training-data operators: odd rows, and the driver's smallest data."""

import pytest

from llm_fixtures import DOC_SCHEMA, SF, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(0, 1, 0), (7, 1, 0), (7, 0, 1), (8, None, None), (None, 1, 1), (99, 0, 1)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
