import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import session, tables
from feedmerge.session import configure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return configure(session(8))


@pytest.fixture(scope="session")
def db():
    return tables(SF)


@pytest.fixture
def sf():
    return SF
