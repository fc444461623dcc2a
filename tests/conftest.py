import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marlstone.session import build

    shared = tmp_path_factory.mktemp("shared")
    session = build("local[4]", 4, "3g", **{"spark.checkpoint.dir": f"file://{shared}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    """The rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
