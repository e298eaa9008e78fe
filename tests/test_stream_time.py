"""Prefix aggregates and stream-time store sales against record-by-record models."""

from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream.operators import stream_time as S
from tillstream.operators.running import prefix

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
SLOW = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DDL = "partition int, arrival bigint, k bigint, storeID string, event_time timestamp, totalAmount double"

record = st.tuples(st.sampled_from(["S1", "S2", "S3", None]),
                   st.one_of(st.none(), st.integers(0, 300)),  # minutes
                   st.one_of(st.none(), st.integers(-300, 9000).map(lambda c: c / 100)))


def as_rows(records):
    """Arrival in list order, two records for each arrival number; the store gives the partition."""
    part = {"S1": 0, "S2": 1, "S3": 1, None: None}
    return [(part[s], i // 2, i, s, None if m is None else (T0 + timedelta(minutes=m)).replace(
        tzinfo=None), a) for i, (s, m, a) in enumerate(records)]


def model(rows, tick=None, size=60, advance=5, grace=2):
    """Record by record, as a stream processor: totals, emissions and releases."""
    stream, totals, emitted, released = {}, defaultdict(int), {}, {}
    for part, arrival, k, store, at, amount in rows:
        if at is not None:
            m = (at - T0.replace(tzinfo=None)) // timedelta(minutes=1)
            stream[part] = max(stream.get(part, m), m)
            for (p, s, end) in list(totals):
                if p == part and end + grace <= stream[part]:
                    released.setdefault((s, end), k)
            first = m // advance * advance + advance
            for end in range(first, first + size, advance):
                if end + grace > stream[part]:
                    totals[part, store, end] += round((amount or 0) * 100)
                    if tick:
                        emitted[arrival // tick, store, end] = totals[part, store, end]
    final = {(s, e): v for (_, s, e), v in totals.items()}
    return final, emitted, {w: (final[w], k) for w, k in released.items()}


def _end(row):
    return (row.window_end - T0.replace(tzinfo=None)) // timedelta(minutes=1)


@settings(max_examples=12, **SLOW)
@given(st.lists(record, max_size=60), st.sampled_from([1, 7, 1000]))
def test_stream_time_operators_equal_the_record_model(spark, records, bucket):
    rows = as_rows(records)
    df = S.with_stream_time(spark.createDataFrame(rows, DDL), bucket)
    final, emitted, released = model(rows, tick=3)
    got = {(r.storeID, _end(r)): round(r.totalSale * 100) for r in S.graced_store_sales(df).collect()}
    assert got == final
    log = S.store_sales_changelog(df, F.floor(F.col("arrival") / 3)).collect()
    assert {(r.tick, r.storeID, _end(r)): round(r.totalSale * 100) for r in log} == emitted
    assert len(log) == len(emitted)
    out = S.suppressed_store_sales(df).collect()
    assert {(r.storeID, _end(r)): (round(r.totalSale * 100), r.released_by) for r in out} == released
    assert len(out) == len(released)
    for r in out:
        assert r.released_at == r.released_by // 2


def test_other_windows(spark):
    rows = as_rows([("S1", m, 1.0) for m in (3, 14, 40, 12, 90, 27)])
    df = S.with_stream_time(spark.createDataFrame(rows, DDL), 4)
    final, _, released = model(rows, size=30, advance=10, grace=15)
    got = S.graced_store_sales(df, 30, 10, 15).collect()
    assert {(r.storeID, _end(r)): r.totalSale * 100 for r in got} == final
    out = S.suppressed_store_sales(df, 30, 10, 15).collect()
    assert {(r.storeID, _end(r)): (r.totalSale * 100, r.released_by) for r in out} == released
    with pytest.raises(ValueError):
        S.graced_store_sales(df, 30, 7, 0)


@settings(max_examples=15, **SLOW)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50)),
                          st.one_of(st.none(), st.integers(-9, 9))), max_size=50),
       st.integers(1, 40))
def test_prefix_of_every_kind(spark, rows, width):
    rows = [(key, at, i, v, v, v, v) for i, (key, at, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "key string, at int, i int, s int, c int, hi int, lo int")
    got = {r.i: r for r in prefix(df, ["key"], ["at", "i"], {
        "s": "sum", "c": "count", "hi": "max", "lo": "min"}, F.floor(F.col("at") / width)).collect()}
    assert len(got) == len(rows)
    for key in ("a", "b", None):
        seen = []
        own = [r for r in rows if r[0] == key]
        for r in sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            seen += [r[3]] if r[3] is not None else []
            g = got[r[2]]
            assert (g.run_s, g.run_c, g.run_hi, g.run_lo) == (
                sum(seen), len(seen), max(seen, default=None), min(seen, default=None))


def test_unknown_aggregate(spark):
    with pytest.raises(ValueError):
        prefix(spark.range(3), [], ["id"], {"id": "avg"}, F.lit(0))


def test_no_single_task_window_and_no_row_expansion(spark):
    """Records are windowed by (partition, bucket); only pane sums are laid out over windows."""
    rows = as_rows([("S1", m, 1.0) for m in range(30)])
    df = S.with_stream_time(spark.createDataFrame(rows, DDL), 4)
    plan = S.graced_store_sales(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    explode = plan.index("Generate explode")
    assert "HashAggregate" in plan[explode:], "the explode stands above a partial aggregate"
