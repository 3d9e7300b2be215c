import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("hourcast-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "6g")  # one JVM for the whole suite
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from hourcast.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def hourly_fixture(spark):
    """The reference's 1000-row hourly fixture: seed 42, columns drawn
    independently (so hr / mnth / yr do not agree with the timestamp)."""
    rng = np.random.default_rng(42)
    n = 1000
    ts = pd.date_range("2011-01-01", periods=n, freq="h")
    pdf = pd.DataFrame({
        "series_id": "all", "row_id": np.arange(n, dtype=np.int64), "timestamp": ts, "dteday": ts.date,
        "season": rng.integers(1, 5, n).astype(np.int32), "yr": rng.integers(0, 2, n).astype(np.int32),
        "mnth": rng.integers(1, 13, n).astype(np.int32), "hr": rng.integers(0, 24, n).astype(np.int32),
        "holiday": rng.integers(0, 2, n).astype(np.int32), "workingday": rng.integers(0, 2, n).astype(np.int32),
        "weekday": rng.integers(0, 7, n).astype(np.int32), "weathersit": rng.integers(1, 5, n).astype(np.int32),
        "temp": rng.random(n), "atemp": rng.random(n), "hum": rng.random(n), "windspeed": rng.random(n),
        "casual": rng.integers(0, 200, n).astype(np.int64), "registered": rng.integers(0, 500, n).astype(np.int64),
        "cnt": rng.integers(0, 700, n).astype(np.int64),
    })
    sch = ("series_id string, row_id long, timestamp timestamp_ntz, dteday date, season int, yr int, mnth int, "
           "hr int, holiday int, workingday int, weekday int, weathersit int, temp double, atemp double, hum double, "
           "windspeed double, casual long, registered long, cnt long")
    return spark.createDataFrame(pdf, sch), pdf
