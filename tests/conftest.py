import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import get_spark
    # The checkpoint folder comes from the session configuration when it names one;
    # get_spark only creates a scratch folder when it is unset.
    s = get_spark("cadenza-tests", master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
