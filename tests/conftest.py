import pytest

from propensity import scale
from propensity.session import build_session
from shared import FOLDER
from synthetic import buyers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def tiny_tasks(monkeypatch):
    """Ranges of a few rows, so that small tables are cut into many."""
    monkeypatch.setattr(scale, "MOST_ROWS", 40)
    monkeypatch.setattr(scale, "LEAST_ROWS", 20)
    monkeypatch.setattr(scale, "SAMPLE_ROWS", 200)
    monkeypatch.setattr(scale, "SAMPLE_PER_RANGE", 5)


@pytest.fixture(scope="session")
def buyers_7k(spark):
    df = buyers(spark, 7000).cache()
    yield df
    df.unpersist()
