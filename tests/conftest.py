import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from censusmart.session import local_session

    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), …)``"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def rows():
    """Rows as sorted tuples, NULLs first."""
    def as_tuples(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
    return as_tuples
