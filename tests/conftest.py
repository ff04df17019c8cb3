import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lynxrisk.config import RunContext, Scale  # noqa: E402
from lynxrisk.sources.session import local_session  # noqa: E402

# sizes at which every operator takes its distributed form on a handful of rows
TINY = Scale(window_rows=5, chunk_rows=7, percentile_rows=5, quantile_rest=8)
CTX = RunContext(dt.datetime(2026, 1, 31), "test", "run-t")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(n: int) -> dt.date:
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)
