import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapmart.session import builder


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "6")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
