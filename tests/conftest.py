import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[4]").appName("savora-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
               .config("spark.driver.memory", "4g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """DataFrame from rows and a schema, with the row order as ``row_idx``."""
    def make(rows, schema):
        return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"row_idx long, {schema}")
    return make


@pytest.fixture
def value(spark):
    """Value of an expression over one literal string."""
    from pyspark.sql import functions as F

    def evaluate(build, text):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(build(F.col("t")).alias("v")).first()["v"]
    return evaluate
