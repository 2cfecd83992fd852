import pytest
from pyspark.sql import SparkSession

from daybook.session import configure


@pytest.fixture(autouse=True)
def usual_broadcast(request):
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[2]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()
