import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from closewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus="8", shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small frame from rows and a schema text."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


def rows(df, *columns):
    """Rows as tuples, sorted with nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
