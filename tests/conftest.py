import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from starmart.session import build_session

    s = build_session(
        "local[*]",
        app_name="starmart-tests",
        shuffle_partitions=8,
        extra={
            "spark.ui.showConsoleProgress": "false",
            # Tests set their own checkpoint folder (the cluster names one).
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="starmart-test-ckpt-"),
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="starmart-test-wh-")
