import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("OMP_NUM_THREADS", "2")

import pytest  # noqa: E402

from quarry.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
