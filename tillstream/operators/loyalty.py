"""Loyalty points per customer card: latest state, keyed reduce, running total.

Order among a card's invoices is (event time, tie key). Totals of points are
the exact total of the amounts times the factor (``functions.money``), so they
do not depend on the order in which partitions combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.money import PARTS, money_parts, money_sum, total_of
from tillstream.operators.running import prefix, sliced
from tillstream.operators.stateless import earned_points, prime_filter

CARD = "customerCardNo"
#: Width of a running total's time buckets: an hour for tables, and of single micro-batches.
BUCKET_US = 3_600_000_000
BATCH_BUCKET_US = 1_000_000


def _newest_and_total(d: DataFrame, total: Column, order: Column) -> DataFrame:
    """Per card: the newest row's invoice columns and the total of points."""
    newest = F.max_by(F.struct("invoiceNumber", "totalAmount", "earnedLoyaltyPoints"), order)
    agg = d.groupBy(CARD).agg(newest.alias("_last"), total.alias("_total"))
    return agg.select(
        F.col("_last.invoiceNumber").alias("invoiceNumber"),
        F.col(CARD),
        F.col("_last.totalAmount").alias("totalAmount"),
        F.col("_last.earnedLoyaltyPoints").alias("earnedLoyaltyPoints"),
        F.col("_total").alias("totalLoyaltyPoints"),
    )


def loyalty_latest(df: DataFrame, time_col: str | None = "event_time", tie_col: str = "k",
                   prime_only: bool = True) -> DataFrame:
    """Keyed aggregate, final state: per card the newest invoice's columns and the
    total of earned points (0.0 start). A partial + final aggregate (sort based,
    as the newest-row buffer holds text): a hot card is combined map-side, never
    gathered in one task. Works on batch and streaming (update mode) inputs.

    ``time_col=None`` orders by the tie key alone: arrival order, when the tie
    key is the record's (partition, offset).
    """
    src = prime_filter(df) if prime_only else df
    d = src.withColumn("earnedLoyaltyPoints", earned_points())
    order = F.struct(time_col, tie_col) if time_col else F.col(tie_col)
    return _newest_and_total(d, earned_points(money_sum("totalAmount")), order)


def loyalty_reduce(notifications: DataFrame, time_col: str = "event_time",
                   tie_col: str = "k") -> DataFrame:
    """Keyed reduce over notification records (invoiceNumber, customerCardNo,
    totalAmount, earnedLoyaltyPoints + order columns): the newer value wins and
    its total is the older total plus its own earned points. The first value is
    seeded with its earned points, so the final state equals ``loyalty_latest``
    of the invoices the notifications came from (up to the last bits: here the
    already rounded products are summed)."""
    return _newest_and_total(notifications, money_sum("earnedLoyaltyPoints"),
                             F.struct(time_col, tie_col))


def running_total(df: DataFrame, key: str, order: list[str], values: list[str],
                  bucket: Column) -> DataFrame:
    """Adds ``run_<value>``: running sums per ``key`` in ``order``, the row included; a hot
    key is spread over its buckets (``operators.running.prefix``)."""
    return prefix(df, [key], order, dict.fromkeys(values, "sum"), bucket)


def time_bucket(time_col: str, width_us: int) -> Column:
    return F.floor(F.unix_micros(F.col(time_col).cast("timestamp")) / F.lit(width_us))


def running_points(rows: DataFrame, time_col: str, tie_col: str, width_us: int) -> DataFrame:
    """Adds the parts of the running total of ``totalAmount`` per card (run_ + PARTS)."""
    return running_total(rows.select("*", *money_parts("totalAmount")), CARD,
                         [time_col, tie_col], list(PARTS), time_bucket(time_col, width_us))


def loyalty_changelog(df: DataFrame, time_col: str = "event_time", tie_col: str = "k",
                      prime_only: bool = True, bucket_us: int | None = None) -> DataFrame:
    """One notification per input invoice carrying the card's running total up to
    and including it (the changelog of the keyed aggregate).

    The rows are cut into even slices, so that a card with any share of the rows, even all
    at one time, is spread over tasks; its narrow rows are written to the checkpoint
    folder. With ``bucket_us`` time buckets of that width take
    the place of the slices, and nothing is written.
    """
    src = prime_filter(df) if prime_only else df
    rows = src.select(CARD, "invoiceNumber", "totalAmount", time_col, tie_col)
    if bucket_us is None:
        rows = sliced(rows, [CARD], [time_col, tie_col], name="loyalty-changelog")
        run = running_total(rows.select("*", *money_parts("totalAmount")), CARD,
                            [time_col, tie_col], list(PARTS), F.col("_slice"))
    else:
        run = running_points(rows, time_col, tie_col, bucket_us)
    return run.select(
        "invoiceNumber", CARD, "totalAmount",
        earned_points().alias("earnedLoyaltyPoints"),
        earned_points(total_of("run_")).alias("totalLoyaltyPoints"),
    )
