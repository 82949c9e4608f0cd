import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from pluvio.session import DEFAULTS
    folder = tempfile.mkdtemp(prefix="pluvio-test-")
    b = SparkSession.builder.master("local[4]").appName("pluvio-tests") \
        .config("spark.sql.shuffle.partitions", "8") \
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse") \
        .config("spark.checkpoint.dir", f"file://{folder}/checkpoints")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from pluvio.session import checkpoint_dir, drop_tables
    checkpoint_dir(s)
    yield s
    drop_tables(s)
