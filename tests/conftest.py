import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    conf = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.checkpoint.dir": f"file://{folder}/checkpoints", "spark.sql.warehouse.dir": f"{folder}/warehouse"}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
