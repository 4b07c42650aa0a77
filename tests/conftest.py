import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.session import local_session  # noqa: E402

SMALL = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "tests", {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-")})
    yield session
    session.stop()


@pytest.fixture(params=[2048, 64])
def layout(request, monkeypatch):
    """Few and many slices per key; 64 grows where a lookback needs more."""
    from tickloom.operators import panel

    plain = panel._run_together
    monkeypatch.setattr(panel, "_run_together", lambda df, blocks, order, rows: plain(df, blocks, order, min(rows, request.param)))
    yield request.param


@pytest.fixture
def rows(spark):
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
