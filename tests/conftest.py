import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trailkeep.session import build_session  # noqa: E402

# Started on import: column expressions at module level of the tests need a session.
SESSION = build_session("tests", "local[8]", **{
    "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
    "spark.checkpoint.dir": tempfile.mkdtemp(prefix="trailkeep-tests-"),
    "spark.python.sql.dataFrameDebugging.enabled": "false",
})
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture()
def column(spark):
    """Values of a column expression over a list of texts."""
    def run(expression, texts, kind="string"):
        rows = [(i, t) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, f"i int, t {kind}")
        return [r.v for r in frame.select("i", expression.alias("v")).orderBy("i").collect()]

    return run
