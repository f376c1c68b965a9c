import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from carelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def rows_of(spark):
    def make(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))

    return make
