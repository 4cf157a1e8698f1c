import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

FIXTURES = ROOT / "tests" / "fixtures"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from quarry.session import build_session
    warehouse = tempfile.mkdtemp(prefix="quarry-warehouse-")
    s = build_session(master="local[*]", shuffle_partitions=8, app="quarry-tests",
                      extra={"spark.sql.warehouse.dir": warehouse,
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="quarry-checkpoints-")})
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
