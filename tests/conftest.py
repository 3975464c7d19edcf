"""One local session for all tests."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import SparkSession

# A local session's executors are this machine, so a folder of it is shared by all of them.
CHECKPOINTS = os.environ.get("TEST_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="sluice-tests-")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def make_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sluice")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.files.maxPartitionBytes", "1m")  # small files still use all cores
        .config("spark.checkpoint.dir", CHECKPOINTS)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return FOLDER
