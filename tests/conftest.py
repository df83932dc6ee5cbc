import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ticketlake.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from ticketlake_queries.shapes import Data

    return Data(spark, SF_DIR)


def rows(df, *order):
    """Rows as tuples, sorted (None first)."""
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted((tuple(r) for r in df.collect()), key=key)
