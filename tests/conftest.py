import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from tidemart.session import shared_dir
    shared_dir(s)  # sets a scratch checkpoint folder only when the session has none
    yield s


@pytest.fixture
def scratch(spark):
    """A fresh folder under the session's shared folder."""
    from tidemart.session import work_path
    return lambda label="t": work_path(spark, f"test-{label}")


@pytest.fixture
def local_dir():
    """Local folder for files that are not Spark data (SQL script files)."""
    return tempfile.mkdtemp(prefix=f"tidemart-test-{uuid.uuid4().hex[:6]}-")
