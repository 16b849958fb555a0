import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from zonalith.session import local_session, reach_workers

    s = local_session(4, 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    reach_workers(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
