from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ratingspark.session import BASE_CONF, apply_session_settings

    b = SparkSession.builder.master("local[4]").appName("ratingspark-tests")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_session_settings(s)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ratingspark-test-ckpt-"))
    yield s
    s.stop()
