from __future__ import annotations

import pytest

from secflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "secflow-tests")
