import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from sheaftext.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    os.chdir(tmp_path_factory.mktemp("cwd"))
    session = local_session("tests", cores="4", memory="4g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def put(tmp_path):
    """Write a text file and return its path."""

    def write(text, name="data.csv", encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode(encoding))
        return str(path)

    return write
