import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    found = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    found.sparkContext.setLogLevel("ERROR")
    if found.sparkContext.getCheckpointDir() is None:
        found.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield found


@pytest.fixture(scope="session")
def sf_dir():
    if not TABLES.is_dir():
        pytest.skip("the driver's tables are not here")
    return str(TABLES)
