import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from callframe.session import get_session
    ckpt = tempfile.mkdtemp(prefix="callframe-test-ckpt-")
    s = get_session("local[2]", shuffle_partitions=4,
                    extra={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
