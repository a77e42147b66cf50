import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketstar.session import build_session

    import tempfile

    warehouse = tempfile.mkdtemp(prefix="marketstar-warehouse-")
    s = build_session(
        "local[*]", shuffle_partitions=8, app="marketstar-tests", conf={"spark.sql.warehouse.dir": warehouse}
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
