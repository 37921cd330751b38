import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session

    s = build_session(4, shuffle_partitions=4, memory="4g")
    s.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    return s
