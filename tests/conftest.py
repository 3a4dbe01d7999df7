import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[4]",
        app_name="daybook-tests",
        shuffle_partitions=4,
    )
    yield session
    session.stop()
