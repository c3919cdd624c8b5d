import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    made = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{base}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/table"
