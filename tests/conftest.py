import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from reachlens.session import local_session, shared_dir
    session = local_session("*", shuffle_partitions=8, app_name="reachlens-tests")
    shared_dir(session, fallback=tempfile.mkdtemp(prefix="reachlens-tests-"))
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    from reachlens.session import shared_dir
    base = shared_dir(spark)
    return tempfile.mkdtemp(prefix="t-", dir=base)
