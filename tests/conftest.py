import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fairlead.session import build  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build("local[4]", shuffle_partitions=4, **{"spark.sql.session.timeZone": "UTC"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("the test tables are not here")
    return SF
