import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parlance.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", "local[4]",
        spark_sql_shuffle_partitions="4", spark_ui_enabled="false",
        spark_sql_warehouse_dir=str(warehouse),
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a column function over a list of texts, in order."""

    from pyspark.sql import functions as F

    def run(function, *texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string").coalesce(1)
        return [r["r"] for r in rows.orderBy("i").select(function(F.col("c")).alias("r")).collect()]

    return run


@pytest.fixture(scope="session")
def small():
    return SMALL
