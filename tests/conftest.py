import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline import schemas  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

RUN_DATE = dt.date(2024, 1, 15)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Tests set their own shared folder; a cluster names one in its conf.
    ckpt = str(tmp_path_factory.mktemp("checkpoint"))
    s = build_session("local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt})
    yield s


@pytest.fixture()
def golden(spark):
    """The fixed 5-row CSV sample (FIXTURES F1)."""
    rows = [
        (1001, 501, "Widget A", 2, 29.99, RUN_DATE),
        (1002, 502, "Widget B", 1, 49.99, RUN_DATE),
        (1003, 503, "Widget A", 3, 29.99, RUN_DATE),
        (1004, 504, "Widget C", 1, 19.99, RUN_DATE),
        (1005, 505, "Widget B", 2, 49.99, RUN_DATE),
    ]
    return spark.createDataFrame(rows, schemas.CSV_SALES)


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_SALES)


@pytest.fixture()
def edge_raw(spark):
    """Raw sales edge rows (FIXTURES F2)."""
    d1, d2 = dt.date(2024, 1, 14), dt.date(2024, 1, 15)
    rows = [
        (1, 100, "Widget A", 2, 25.0, 50.0, d2, "North", "Online"),     # exactly 50
        (2, 100, "Gadget X", 4, 25.0, 100.0, d2, "South", "Retail"),    # exactly 100, rank peer
        (3, 100, "Widget B", 1, 10.0, 10.0, d1, "East", "Mobile"),      # earlier date
        (4, 101, "widget lower", 0, 10.0, 0.0, d2, "West", "Online"),   # qty 0, lower-case
        (5, 102, "Gadget Widget", -1, 10.0, -10.0, d2, "Mars", "Fax"),  # both words, odd sets
        (6, None, None, 3, 0.0, 0.0, d2, "North", "Online"),            # nulls, price 0
        (7, 103, "Thing", None, None, None, d2, "North", "Online"),     # null q/p/amount
        (8, 104, "Gadget Y", 10, 100.0, 1000.0, d2, "East", "Retail"),  # 1000, qty 10
        (9, 104, "Gadget Y", 11, 100.0, 1100.0, d2, "East", "Retail"),  # > 1000, qty 11
        (None, 105, "Widget C", 3, 33.33, 99.99, d2, "West", "Mobile"),  # null order id
    ]
    return raw_rows(spark, rows)
