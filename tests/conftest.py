import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from ecometrics.session import tune

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate column functions over one text column ``x``."""

    def run(function, inputs):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
        rows = df.select("i", function("x").alias("y")).orderBy("i").collect()
        return [row.y for row in rows]

    return run
