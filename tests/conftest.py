import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    from wattflow.session import DEFAULT_CONF

    builder = SparkSession.builder.master("local[4]").appName("wattflow-tests")
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": "8",
                 "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests run without a cluster: the shared checkpoint folder is unset, so set one
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
