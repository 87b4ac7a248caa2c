import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from learnmetrics.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(
        "learnmetrics-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra_conf={"spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lm-ckpt-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (sorted), optionally projected."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
