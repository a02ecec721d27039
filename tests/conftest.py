import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from pyspark.sql import SparkSession

    from ledgerloom.session import ensure_checkpoint_dir

    warehouse = tempfile.mkdtemp(prefix="ledgerloom-wh-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("ledgerloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session, local_fallback=True)
    yield session
    session.stop()
