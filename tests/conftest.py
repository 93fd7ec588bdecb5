import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    at = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[2]").appName("tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(at / "warehouse")).config("spark.checkpoint.dir", str(at / "shared"))
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    import __spark_entry__

    __spark_entry__._shipped(session)
    yield session
    session.stop()
