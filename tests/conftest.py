import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from voxloom.session import local_session, ship_package  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# column expressions in the test modules need a session when they are imported
SESSION = local_session(cpus=8)
ship_package(SESSION)


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture()
def column(spark):
    """Apply an expression to a list of values: column(values, expression, type) -> list."""

    def run(values, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {kind}")
        return [r[1] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]

    return run
