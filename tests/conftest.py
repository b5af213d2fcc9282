import pytest
from pyspark.sql import SparkSession

from wardlens.session import SETTINGS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("tests")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.sql.debug.maxToStringFields": "1000",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def no_auto_broadcast(spark):
    """Only explicit broadcasts, as with tables beyond the automatic threshold."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
