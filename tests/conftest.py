import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillbook.session import session_configs

    builder = SparkSession.builder.master("local[4]").appName("tillbook-tests")
    for key, value in session_configs(cpus=4, shuffle_partitions=8).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # tests use their own shared folder only when the session names none
    if not session.conf.get("spark.checkpoint.dir", None) and session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillbook-tests-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.compare import duck_connection

    return duck_connection(SF_SMALL)
