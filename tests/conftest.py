import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def silver(spark):
    """Make a silver frame from partial rows; columns not given are NULL."""
    from engagement_lake.sources.schemas import column_types, complete

    def make(table, rows):
        kinds = {**column_types(table), "snapshot_date": "STRING"}
        names = list(dict.fromkeys(n for row in rows for n in row))
        text = [n for n in names if kinds[n] == "TIMESTAMP"]
        ddl = ", ".join(f"{n} {'STRING' if n in text else kinds[n]}" for n in names)
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)
        return complete(df.withColumns({n: df[n].cast("timestamp") for n in text}), table)

    return make
