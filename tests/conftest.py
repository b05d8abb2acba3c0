import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from urbana.session import build_session

    s = build_session("local[4]", 4, "urbana-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
