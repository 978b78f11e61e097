import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="geoferry-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture
def folder(spark):
    from geoferry.workspace import new_folder

    return lambda name="out": new_folder(spark, name)


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
