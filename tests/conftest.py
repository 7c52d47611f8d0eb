import sys
import tempfile
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from support_core import order_frame  # noqa: E402

from stratalake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="stratalake-warehouse-")
    session = build_session("tests", "local[8]", 8, {"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path)


@pytest.fixture
def orders(spark):
    """Five orders of two customers."""
    return order_frame(
        spark,
        [
            ("C001", "ORD001", "2023-01-01", 100.0),
            ("C001", "ORD002", "2023-01-05", 150.0),
            ("C001", "ORD003", "2023-01-10", 200.0),
            ("C002", "ORD004", "2023-01-02", 50.0),
            ("C002", "ORD005", "2023-01-08", 75.0),
        ],
    )
