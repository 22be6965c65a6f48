import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.host": "127.0.0.1", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"}
    return SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
