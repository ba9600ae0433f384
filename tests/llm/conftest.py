"""Fixtures of the operators' tests."""

import pytest
from llm_fixtures import frame, texts


@pytest.fixture(scope="session")
def corpus():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
