from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabsmith.session import get_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tabsmith-warehouse-")
    session = get_session(
        "local[4]", app="tabsmith-tests", shuffle_partitions=4, conf={"spark.sql.warehouse.dir": warehouse}
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tabsmith-test-")
