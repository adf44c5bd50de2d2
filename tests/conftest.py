import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(4, "tests", **{
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "shared"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}",
        "spark.sql.shuffle.partitions": "4",
    })
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_cached_for_others():
    """What a module's tests have cached does not count in the next module."""
    yield
    if (session := SparkSession.getActiveSession()) is not None:
        session.catalog.clearCache()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not Path(SMALL).exists():
        pytest.skip("no given tables")
    return SMALL


def values(df, *columns):
    """Rows as plain tuples, in order of the first column."""
    return sorted((tuple(r) for r in df.select(*columns).collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
