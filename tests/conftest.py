import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from support import INVOICE_DDL, make_invoice  # noqa: E402
from tillstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture
def invoices(spark):
    addr = ("line 1", "Pune", "MH", "411001", "999")
    li = [("10", "Desk", 100.0, 2, 200.0), ("11", "Lamp", 25.5, 1, 25.5)]
    rows = [
        make_invoice(1, "C1", 200.0, "PRIME", "home-delivery", addr, li, minute=1),
        make_invoice(2, "C1", 50.0, "prime", "HOME-DELIVERY", addr, li[:1], minute=2),
        make_invoice(3, "C2", 10.0, "NONPRIME", "TAKEAWAY", None, li[1:], minute=3),
        make_invoice(4, "C2", 99.99, "Prime", None, None, [], minute=4),
        make_invoice(5, "C3", 1.0, None, "HOME-DELIVERY", None, li, minute=5),
        make_invoice(6, "C1", 25.0, "PRIME", "takeaway", None, li[:1], minute=6),
    ]
    return spark.createDataFrame(rows, INVOICE_DDL)
