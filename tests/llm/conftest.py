import pytest

from footfall.session import ship


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark
