import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from signalbox.session import build_session

    s = build_session(
        "local[4]",
        app_name="signalbox-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="signalbox-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="signalbox-test-")


def rows(df, *cols, order=None):
    """Collected rows as tuples, sorted for order-free comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t)) if order is None else out
