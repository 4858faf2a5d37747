import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake import Lake, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        local=True,
        cores=4,
        conf={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def location(tmp_path):
    return f"file:{tmp_path}/table"


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(
        abbr=f"t-{abs(hash(str(tmp_path))) % 10**10}",
        country="de",
        project="sales",
        buckets={layer: f"file:{tmp_path}/{layer}" for layer in ("raw", "refined", "curated")},
    )
    made.create_databases(spark)
    return made


def rows(df):
    """Rows without their order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
