import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickstar import runtime  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = runtime.session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as a set of tuples, which also says there are no repeats."""
    got = [tuple(row) for row in df.select(*(columns or df.columns)).collect()]
    assert len(got) == len(set(got)), "repeated rows"
    return set(got)
