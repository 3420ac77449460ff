import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rollcall.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("scratch"))
    session = build_session(
        "local[4]", shuffle_partitions=4, memory="4g", settings={"spark.checkpoint.dir": folder}
    )
    # Small tables would be coalesced to one partition, which would hide the seams between ranges.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session
    session.stop()
