import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app_name="ledgerflow-tests")
    yield s
    s.stop()
