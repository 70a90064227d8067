import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import local_session  # noqa: E402

RUN = "run_test"
NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = local_session("tests", "4", **{
        "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(scratch),
        "spark.sql.warehouse.dir": str(scratch / "warehouse"),
    })
    yield session
    session.stop()
