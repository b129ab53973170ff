import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    top = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    conf = {"spark.master": "local[4]", "spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": f"{top}/warehouse", "spark.checkpoint.dir": f"{top}/shared", "spark.sql.session.timeZone": "UTC"}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
