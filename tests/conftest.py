import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ck = tempfile.mkdtemp(prefix="cohort-tests-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("cohort-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ck)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from cohort_spark import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
