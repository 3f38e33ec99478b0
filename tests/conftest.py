import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from foliospark import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
