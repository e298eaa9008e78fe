from datetime import datetime

from pyspark.sql import functions as F

from tillstream.operators import store_sales
from tillstream.sources import adapters

from support import SF001


def _events(spark, rows):
    return spark.createDataFrame(rows, "storeID string, totalAmount double, event_time timestamp, k long")


def test_panes_equal_direct_window(spark):
    ev = adapters.store_events(spark, SF001)
    a = store_sales.hopping_store_sales(ev, method="panes")
    b = store_sales.hopping_store_sales(ev, method="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_each_row_in_twelve_windows(spark):
    ev = adapters.store_events(spark, SF001)
    total = ev.agg(F.sum(F.round(F.col("totalAmount") * 100).cast("long"))).first()[0]
    hop = store_sales.hopping_store_sales(ev)
    s = hop.agg(F.sum(F.round(F.col("totalSale") * 100).cast("long"))).first()[0]
    assert s == 12 * total


def test_all_null_store_sums_to_zero(spark):
    t = datetime(2024, 1, 1, 0, 7)
    ev = _events(spark, [("S0", None, t, 1), ("S1", 5.0, t, 2)])
    for method in ("panes", "window"):
        out = store_sales.hopping_store_sales(ev, method=method)
        vals = {r.totalSale for r in out.where("storeID = 'S0'").collect()}
        assert vals == {0.0}
        assert out.where("storeID = 'S0'").count() == 12


def test_window_bounds_and_unwrap(spark):
    ev = _events(spark, [("S1", 1.5, datetime(2024, 1, 1, 0, 7), 1)])
    out = store_sales.hopping_store_sales(ev).orderBy("window_start").collect()
    assert out[0].window_start == datetime(2023, 12, 31, 23, 10)
    assert out[-1].window_start == datetime(2024, 1, 1, 0, 5)
    assert all((r.window_end - r.window_start).seconds == 3600 for r in out)
    assert store_sales.unwindowed(store_sales.hopping_store_sales(ev)).columns == ["storeID", "totalSale"]


def test_tumbling(spark):
    ev = _events(spark, [("S1", 1.0, datetime(2024, 1, 1, 0, 7), 1),
                         ("S1", 2.0, datetime(2024, 1, 1, 0, 59), 2),
                         ("S1", 4.0, datetime(2024, 1, 1, 1, 0), 3)])
    out = {r.window_start.hour: r.totalSale for r in store_sales.tumbling_store_sales(ev).collect()}
    assert out == {0: 3.0, 1: 4.0}


def test_batch_closed_windows_equal_stream_final_only(spark):
    from tillstream.plans import streams
    from tillstream.session import utc
    with utc(spark):
        ev = adapters.store_events(spark, SF001)
        wm = ev.agg(F.max("event_time") - F.expr("INTERVAL 2 MINUTES")).first()[0]
        batch = store_sales.closed_windows(store_sales.hopping_store_sales(ev), F.lit(wm).cast("timestamp_ntz"))
        stream = streams.store_sales_final_only(spark, SF001)
        assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0
