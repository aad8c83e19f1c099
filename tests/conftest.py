import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskmart.session import build_session
    s = build_session(master="local[4]", app_name="riskmart-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskmart-tests-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def raw_rows(spark, rows):
    """A landing frame from {position: text} dicts (other positions null)."""
    from riskmart import schemas as S
    data = [tuple(r.get(i) for i in range(S.N_EVENT_COLUMNS)) for r in rows]
    return spark.createDataFrame(data, S.EVENTS_POSITIONAL)
