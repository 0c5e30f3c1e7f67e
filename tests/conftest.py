import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("ctxlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        # Tiny inputs: compiling generated code would take most of the time.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Documents from ``{path: content}``."""

    def make(files):
        return spark.createDataFrame(list(files.items()), "file_path string, content string")

    return make
