import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402


SCRATCH = tempfile.TemporaryDirectory(prefix="landfall-tests-", ignore_cleanup_errors=True)  # goes when the process ends


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", SCRATCH.name)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Evaluate one expression set over literal rows: ``rows(ddl, data, **columns)``."""

    def run(ddl, data, *columns):
        return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*columns).collect()]

    return run
