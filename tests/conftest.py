import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from parcelflow.session import build_session
    s = build_session("local[4]", app="parcelflow-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def root():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="pf-test-")
