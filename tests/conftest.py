import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from wordloom.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 8, app="wordloom-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
