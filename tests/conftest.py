import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from depotflow.session import build_session  # noqa: E402
from depotflow.sources import star as model  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": tmp_path_factory.mktemp("warehouse"),
        "spark.checkpoint.dir": tmp_path_factory.mktemp("shared"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return model.sample(spark)


@pytest.fixture()
def rows():
    """Rows of a result as sorted plain tuples."""

    def collect(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in found.collect()), key=repr)

    return collect


@pytest.fixture()
def values():
    """Sorted values of a result's first column."""

    def collect(df):
        return sorted(r[0] for r in df.collect())

    return collect
