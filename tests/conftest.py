import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rungline import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build("tests", "local[8]", 8)
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
