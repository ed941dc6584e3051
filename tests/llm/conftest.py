import pytest

from basketwise.llm.workers import ready


@pytest.fixture(autouse=True)
def importable(spark):
    ready(spark)
