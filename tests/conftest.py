import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siftwork.session import build_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[8]", 4, str(tmp_path_factory.mktemp("checkpoints")))
    s.sparkContext.setLogLevel("ERROR")
    yield prepare(s)
    s.stop()


@pytest.fixture
def rows(spark):
    """``rows(schema, *tuples)`` as a DataFrame."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def evaluate(spark, rows):
    """``evaluate(schema, cases, column)``: the column's value for every case, in order."""

    def run(schema, cases, column):
        df = rows("i int, " + schema, *[(i, *(c if isinstance(c, tuple) else (c,))) for i, c in enumerate(cases)])
        return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]

    return run
