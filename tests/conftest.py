import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from mentidero.session import build_session  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mentidero-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
