import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from sitemerge.session import ensure_checkpoint_dir, local_session

    s = local_session("*", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


SMALL = "/root/testdata/sf0.001"
