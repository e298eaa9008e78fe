import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tillstream.operators import loyalty


def test_latest_and_total_per_card(invoices):
    out = {r.customerCardNo: r for r in loyalty.loyalty_latest(invoices).collect()}
    assert set(out) == {"C1", "C2"}
    c1 = out["C1"]
    assert c1.invoiceNumber == "6" and c1.totalAmount == 25.0
    assert c1.totalLoyaltyPoints == (20000 * 2 + 5000 * 2 + 2500 * 2) / 10000.0
    assert out["C2"].totalLoyaltyPoints == 1.9998


def test_reduce_over_notifications_equals_aggregate(invoices):
    from tillstream.operators.stateless import notification, prime_filter
    notes = notification(prime_filter(invoices), keep=("event_time", "k"))
    a = sorted(map(tuple, loyalty.loyalty_latest(invoices).collect()))
    b = sorted(map(tuple, loyalty.loyalty_reduce(notes).collect()))
    assert [x[:4] for x in a] == [x[:4] for x in b]
    assert [x[4] for x in a] == pytest.approx([x[4] for x in b], rel=1e-14)


def test_changelog_one_row_per_invoice_and_last_equals_latest(invoices):
    cl = loyalty.loyalty_changelog(invoices).collect()
    assert len(cl) == 4
    c1 = sorted((r for r in cl if r.customerCardNo == "C1"), key=lambda r: int(r.invoiceNumber))
    assert [r.totalLoyaltyPoints for r in c1] == [4.0, 5.0, 5.5]


def expected_runs(rows, order):
    """tie -> running sum, for (key, *order columns, tie, value) rows."""
    expect = {}
    for k in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == k), key=order)
        for r, s in zip(grp, accumulate((r[3] or 0) for r in grp)):
            expect[r[2]] = s
    return expect


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_total_hot_key_matches_brute_force(spark, width):
    """One key holds a third of the rows and spans many buckets; nulls in key and value."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        k = "HOT" if i % 3 == 0 else (None if i % 97 == 0 else f"k{rng.randint(0, 40)}")
        v = None if i % 53 == 0 else rng.randint(-50, 500)
        rows.append((k, rng.randint(0, 200), i, v))
    df = spark.createDataFrame(rows, "key string, t int, tie int, v bigint")
    got = {r.tie: r.run_v for r in loyalty.running_total(
        df, "key", ["t", "tie"], ["v"], F.floor(F.col("t") / width)).collect()}
    assert got == expected_runs(rows, lambda r: (r[1], r[2]))


def test_running_total_plan_spreads_a_key_over_buckets(spark):
    """The row-level window is partitioned by key and bucket; nothing runs while it is built."""
    df = spark.range(10).select(F.lit("HOT").alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = loyalty.running_total(df, "k", ["t"], ["v"], F.floor(F.col("t") / 3))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert [r.run_v for r in out.orderBy("t").collect()] == list(accumulate(range(10)))


def test_last_changelog_row_per_card_equals_latest(spark):
    from support import SF001
    from tillstream.sources import adapters
    from tillstream.session import utc
    with utc(spark):
        inv = adapters.invoices(spark, SF001, lines=False, items=False)
        cl = loyalty.loyalty_changelog(inv, bucket_us=86_400_000_000 * 30)
        ranked = cl.join(inv.select("invoiceNumber", "event_time", "k"), "invoiceNumber")
        last = (ranked.groupBy("customerCardNo")
                .agg(F.max_by(F.struct("invoiceNumber", "totalAmount", "earnedLoyaltyPoints",
                                       "totalLoyaltyPoints"), F.struct("event_time", "k")).alias("r"))
                .select("r.invoiceNumber", "customerCardNo", "r.totalAmount",
                        "r.earnedLoyaltyPoints", "r.totalLoyaltyPoints"))
        latest = loyalty.loyalty_latest(inv)
        assert last.exceptAll(latest).count() == 0 and latest.exceptAll(last).count() == 0


def test_running_total_null_and_odd_keys(spark):
    keys = ["a'b", "back\\slash", "new\nline", "ünï", "", None, "$x"]
    rows = [(keys[i % len(keys)], i % 7 if i % 11 else None, i, i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, t int, tie int, v bigint")
    got = {r.tie: r.run_v for r in loyalty.running_total(
        df, "key", ["t", "tie"], ["v"], F.floor(F.col("t") / 2)).collect()}
    assert got == expected_runs(rows, lambda r: (r[1] is not None, r[1] or 0, r[2]))


AMOUNTS = [2e13, 0.004, 33.335, 0.125, 1.0, -7.5, None]


def test_earned_points_are_plain_products(spark):
    from tillstream.operators.stateless import notification
    rows = [(str(i), "C", x) for i, x in enumerate([*AMOUNTS, float("inf")])]
    df = spark.createDataFrame(rows, "invoiceNumber string, customerCardNo string, totalAmount double")
    got = {r.invoiceNumber: r.earnedLoyaltyPoints for r in notification(df).collect()}
    assert got == {n: None if x is None else x * 0.02 for n, _, x in rows}


def test_totals_keep_every_amount(spark):
    import math
    from tillstream.functions.money import money_sum
    groups = {"all": AMOUNTS, "nan": [1.0, float("nan")], "inf": [1.0, float("inf")], "null": [None],
              "big": [1e20, 1.0, -1e20], "cents": [0.1] * 1000, "third": [1 / 3] * 30}
    df = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v], "g string, x double")
    for n in (1, 7):
        got = {r.g: r.s for r in df.repartition(n).groupBy("g").agg(money_sum("x").alias("s")).collect()}
        assert got["all"] == math.fsum(x for x in AMOUNTS if x is not None)
        assert math.isnan(got["nan"]) and got["inf"] == float("inf") and got["null"] == 0.0
        assert got["big"] in (0.0, 1.0) and got["cents"] == 100.0
        assert abs(got["third"] - 10.0) < 1e-10


def test_latest_by_arrival(spark):
    """Without a time column the tie key (arrival) decides, not the event time."""
    from datetime import datetime
    rows = [("C", "new", 1.0, "PRIME", datetime(2024, 1, 2), 5), ("C", "late", 2.0, "PRIME", datetime(2024, 1, 1), 6)]
    df = spark.createDataFrame(rows, "customerCardNo string, invoiceNumber string, totalAmount double, "
                                     "customerType string, event_time timestamp, k long")
    assert loyalty.loyalty_latest(df).first().invoiceNumber == "new"
    assert loyalty.loyalty_latest(df, time_col=None).first().invoiceNumber == "late"


def test_slices_split_a_key_evenly_and_keep_the_order(spark):
    """Most rows belong to one card and one time: slices stay small, totals are exact."""
    from tillstream.operators.running import prefix, sliced
    rows = [("hot", 5, i, (i * 37) % 101) for i in range(3000)] + [
        (f"c{i % 40}" if i % 41 else None, i % 7, i, i % 13) for i in range(400)]
    df = spark.createDataFrame(rows, "card string, at int, i int, v int").repartition(6)
    cut = sliced(df, ["card"], ["at", "i"], slices=10)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 3 * 3400 / 10
    got = {(r.card, r.i): r.run_v for r in prefix(cut, ["card"], ["at", "i"], {"v": "sum"},
                                                  F.col("_slice")).collect()}
    want, total = {}, {}
    for card, at, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        total[card] = total.get(card, 0) + v
        want[card, i] = total[card]
    assert got == want
