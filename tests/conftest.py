import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from geoobs.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        8, "tests", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=shared
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
