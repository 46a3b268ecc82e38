import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


def session():
    from adgleaner.session import build_session

    spark = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    yield session()


@pytest.fixture
def rows(spark):
    """Evaluate one column over literal rows."""

    def run(schema, data, *columns):
        return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]

    return run
