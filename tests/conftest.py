import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starloom import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build_session(
        "starloom-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def texts(spark):
    """A frame of text columns from rows of Python values."""

    def make(columns, *rows):
        schema = ", ".join(f"{c} string" for c in columns)
        return spark.createDataFrame([tuple(row) for row in rows], schema)

    return make
