import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sievegate.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"}
    )
    yield session
    session.stop()
