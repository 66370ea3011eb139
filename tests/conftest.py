import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from listingflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("8", shuffle_partitions=4, memory="6g", checkpoint_dir=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as plain tuples, sorted so that nulls and mixed types do not matter."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
