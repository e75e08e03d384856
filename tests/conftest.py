import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from importlens.session import build_session
    ckpt = tempfile.mkdtemp(prefix="importlens-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8, app_name="importlens-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="importlens-test-")


def write_text(folder: str, name: str, text: str) -> str:
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path
