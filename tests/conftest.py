import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("planekit-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="planekit-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="planekit-test-")


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all if none)."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
