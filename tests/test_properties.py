"""Property tests: bucketed running totals equal a serial scan for any data and
any bucket width; pane and direct windows agree on random events."""

from datetime import datetime, timedelta
from itertools import accumulate

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tillstream.operators import loyalty, store_sales

ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "hot", None]), st.integers(0, 20),
              st.one_of(st.none(), st.integers(-1000, 1000))),
    min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, width=st.integers(1, 9))
def test_running_total_any_width(spark, rows, width):
    data = [(k, t, i, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "key string, t int, tie int, v bigint")
    got = {r.tie: r.run_v for r in loyalty.running_total(
        df, "key", ["t", "tie"], ["v"], F.floor(F.col("t") / width)).collect()}
    expect = {}
    for k in {r[0] for r in data}:
        grp = sorted((r for r in data if r[0] == k), key=lambda r: (r[1], r[2]))
        for r, s in zip(grp, accumulate((r[3] or 0) for r in grp)):
            expect[r[2]] = s
    assert got == expect


EVENTS = st.lists(st.tuples(st.sampled_from(["S1", "S2"]), st.integers(0, 600),
                            st.one_of(st.none(), st.integers(1, 99999))), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ev=EVENTS, size=st.sampled_from([10, 30, 60]), adv=st.sampled_from([5, 10]))
def test_panes_equal_window_form(spark, ev, size, adv):
    base = datetime(2024, 3, 1)
    rows = [(s, None if c is None else c / 100.0, base + timedelta(minutes=m), i)
            for i, (s, m, c) in enumerate(ev)]
    df = spark.createDataFrame(rows, "storeID string, totalAmount double, event_time timestamp, k long")
    a = store_sales.windowed_store_sales(df, size, adv, method="panes")
    b = store_sales.windowed_store_sales(df, size, adv, method="window")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


TYPES = st.sampled_from(["HOME-DELIVERY", "home-delivery", "Home-Delivery", "TAKEAWAY", None])
CTYPES = st.sampled_from(["PRIME", "prime", "NONPRIME", None])
LINE = st.tuples(st.integers(1, 50), st.integers(1, 5000), st.integers(1, 4))
INVOICE = st.tuples(TYPES, CTYPES, st.booleans(), st.lists(LINE, max_size=4),
                    st.integers(0, 99999))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(invs=st.lists(INVOICE, min_size=1, max_size=12))
def test_stateless_operators_match_python_model(spark, invs):
    from support import INVOICE_DDL, make_invoice
    from tillstream.operators import stateless

    rows, flat_lines = [], []
    for i, (dt, ct, has_addr, lines, cents) in enumerate(invs):
        addr = ("l", f"city{i}", "st", "000001", "555") if has_addr else None
        li = [(str(code), f"item{code}", price / 100, qty, price * qty / 100)
              for code, price, qty in lines]
        rows.append(make_invoice(i, f"C{i % 3}", cents / 100, ct, dt, addr, li, minute=i))
        flat_lines += [(i,) + x for x in li]
    inv = spark.createDataFrame(rows, INVOICE_DDL)
    home = {i for i, (dt, *_rest) in enumerate(invs) if dt is not None and dt.upper() == "HOME-DELIVERY"}
    prime = {i for i, (_, ct, *_r) in enumerate(invs) if ct is not None and ct.upper() == "PRIME"}

    assert {int(r.invoiceNumber) for r in stateless.shipment_filter(inv).collect()} == home
    assert {int(r.invoiceNumber) for r in stateless.prime_filter(inv).collect()} == prime

    recs = stateless.hadoop_records(inv).collect()
    assert len(recs) == sum(len(x[3]) for x in invs)
    for r in recs:
        i = int(r.invoiceNumber)
        assert (r.city is not None) == (i in home and invs[i][2])

    lines_df = spark.createDataFrame(
        flat_lines, "l_orderkey long, itemCode string, itemDescription string, itemPrice double, "
                    "itemQty int, totalValue double")
    flat = stateless.hadoop_records_from_lines(inv, lines_df)
    nested = stateless.hadoop_records(inv)
    assert flat.exceptAll(nested).count() == 0 and nested.exceptAll(flat).count() == 0

    for r in stateless.mask_invoice(inv).collect():
        i = int(r.invoiceNumber)
        assert r.customerCardNo is None
        if r.deliveryAddress is not None:
            masked = i in home
            assert (r.deliveryAddress.addressLine is None) == masked
            assert (r.deliveryAddress.contactNumber is None) == masked
            assert r.deliveryAddress.city == f"city{i}"

    notes = {int(r.invoiceNumber): r.earnedLoyaltyPoints
             for r in stateless.notification(inv).collect()}
    assert notes == {i: x[4] / 100 * 0.02 for i, x in enumerate(invs)}
