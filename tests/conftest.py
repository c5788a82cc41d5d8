import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from urbanflow.session import build_session, clean_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("urbanflow-tests", "local[*]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clean_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="urbanflow-test-")


def rows(df, *cols):
    """Collect selected columns as plain tuples (order preserved)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
