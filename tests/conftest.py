import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstar.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_workspace(spark):
    from tillstar.plans.star import workspace

    return workspace(spark, SMALL)


def rows(df, *order):
    """Collected rows as tuples, ordered by the given columns or completely."""
    found = [tuple(r) for r in df.collect()]
    if order:
        positions = [df.columns.index(c) for c in order]
        return sorted(found, key=lambda r: tuple(r[p] for p in positions))
    return sorted(found, key=repr)
