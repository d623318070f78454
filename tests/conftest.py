"""A local session for the tests; the library itself never creates one."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def make_session(cpus: int | str = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(params=["lookup", "shuffle"])
def join_path(request, spark):
    """Runs a test with small sides broadcast, and with everything shuffled."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if request.param == "shuffle":
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.set(key, before)
