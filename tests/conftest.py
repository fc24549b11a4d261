import os
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["TZ"] = "UTC"  # collected timestamps are in local time
time.tzset()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("packedts-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")  # short jobs, quick start
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(base / "scratch"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
