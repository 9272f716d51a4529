import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docops.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4, memory="6g")
    yield session
    session.stop()
