"""One local session for all tests, with a checkpoint folder of its own."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lectern.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("tests", cores="4", shuffle_partitions=4, memory="4g", shared=str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def data():
    at = Path("/root/testdata/sf0.001")
    if not at.exists():
        pytest.skip("no test data")
    return str(at)
