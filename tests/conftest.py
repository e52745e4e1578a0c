import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tillwise import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tests", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC"})
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
