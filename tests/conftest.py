import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seawarden.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        4,
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture(scope="session")
def events(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet")


def rows(df):
    """All rows as sorted tuples, columns by name."""
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def plan_of(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
