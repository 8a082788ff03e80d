import os
from pathlib import Path

import pytest

# Spark's Python workers import the package from here
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parent.parent), *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
