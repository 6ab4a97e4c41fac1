import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from dossier.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions=4, spark__ui__enabled="false", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate one column expression on one row."""
    def run(make, *values, types=None):
        names = [f"c{i}" for i in range(len(values))]
        if values:
            schema = ", ".join(f"{n} {t}" for n, t in zip(names, types or ["string"] * len(values)))
            df = spark.createDataFrame([tuple(values)], schema)
        else:
            df = spark.range(1)
        return df.select(make(*[df[n] for n in names]).alias("v")).head()["v"]
    return run
