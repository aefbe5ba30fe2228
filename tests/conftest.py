import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from homelake.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of a column expression over ``x`` for a list of texts."""

    def run(expression, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
        return [r.v for r in rows.select("i", expression.alias("v")).orderBy("i").collect()]

    return run
