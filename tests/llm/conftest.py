import pytest

from churnkit.llm.registry import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
