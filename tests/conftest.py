import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratecraft.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="ratecraft-test-ckpt-")
    s = build_session("local[4]", app_name="ratecraft-tests", shuffle_partitions=8,
                      extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
