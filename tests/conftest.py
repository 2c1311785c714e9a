from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="loanloom-tests-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("loanloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
