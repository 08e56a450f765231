import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketlab.schemas import RAW  # noqa: E402
from basketlab.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", "basketlab-tests", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false",
        "spark.default.parallelism": "4",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="basketlab-tests-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s


D = dt.date


def raw_df(spark, rows):
    """Rows as (InvoiceNo, StockCode, Description, Quantity, InvoiceDate,
    UnitPrice, CustomerID, Country)."""
    return spark.createDataFrame(rows, RAW)
