import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from foresight.session import get_session  # noqa: E402
from tests.fixtures import plant  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("foresight-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_plant(spark):
    return plant(spark)
