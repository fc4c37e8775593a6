import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from zonepulse.session import build_session

    ckpt = tempfile.mkdtemp(prefix="zonepulse-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="zonepulse-test-warehouse-")
    session = build_session(
        "local[4]",
        app_name="zonepulse-tests",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


def plan_text(df, mode="formatted"):
    """The text ``DataFrame.explain`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="zonepulse-test-")
