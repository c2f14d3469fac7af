import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("leavewatch-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "6g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clean_log(spark):
    """Clean sample log, times in milliseconds, stored once."""
    from leavewatch.operators.cleaning import clean_events
    from leavewatch.sources.sample_log import read_sample_log
    from leavewatch.sources.shared_storage import cut_lineage
    return cut_lineage(clean_events(read_sample_log(spark, MEDIUM), seconds=False))


@pytest.fixture(scope="session")
def features(clean_log):
    from leavewatch.operators.users import user_features
    from leavewatch.sources.shared_storage import cut_lineage
    return cut_lineage(user_features(clean_log))
