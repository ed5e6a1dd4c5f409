import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4, spark__checkpoint__dir=str(base / "shared"), spark__sql__warehouse__dir=str(base / "warehouse")
    )
    yield session
    session.stop()
