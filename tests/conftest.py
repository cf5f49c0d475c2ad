import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parents[1])
sys.path.insert(0, ROOT)
sys.path.insert(0, str(Path(__file__).parent))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, str(Path(__file__).parent), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from gavel.session import build_session

    session = build_session("local[4]", 4, "6g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
