from __future__ import annotations

import pytest

from terrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("terrace-tests", cores=4, partitions=4)
