import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from stratiform.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def rows_of():
    """Rows as a sorted list of tuples, for comparisons."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
