import pytest
from pyspark.sql import SparkSession

from tests.rounds import match_rows
from tourney.schema import BRONZE


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tourney-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze_of(spark):
    """Bronze frame of ``(run, a, b, moves)`` matches, moves being pairs such as ``CD``."""

    def build(*matches):
        rows = [row for match in matches for row in match_rows(*match)]
        return spark.createDataFrame(rows, BRONZE)

    return build
