import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lectern.session import configure
    session = (configure(SparkSession.builder).master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def phrases(spark):
    from lectern import vocab
    return spark.createDataFrame([(p,) for p in vocab.DEFAULT_BLOCKLIST], "phrase string")
