"""Streaming forms of the keyed aggregates.

``loyalty_updates``: keyed aggregate of notifications, update mode (a
changelog: each trigger re-emits the cards it changed). Loyalty state has no
window, so it grows with the number of cards (RocksDB state store).

``store_sales_stream``: windowed sum per store with a watermark of the grace
period; update mode re-emits changed (window, store) totals, append mode
emits each window once, after it closes. ``store_sales_panes_stream`` does the
latter with one state row per pane instead of one per window that covers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.constants import WINDOW_ADVANCE_MINUTES, WINDOW_GRACE_MINUTES, WINDOW_SIZE_MINUTES
from tillstream.functions.money import money_parts, part_sums, total_of
from tillstream.operators.loyalty import loyalty_latest
from tillstream.operators.store_sales import windowed_store_sales


def loyalty_updates(invoices: DataFrame, time_col: str | None = "event_time",
                    tie_col: str = "k", prime_only: bool = True) -> DataFrame:
    """The keyed aggregate on a stream; run it in update mode for the changelog.

    With ``time_col=None`` the latest invoice is the last to arrive, if the tie
    key is the record's (partition, offset): a card's records share a partition.
    """
    return loyalty_latest(invoices, time_col, tie_col, prime_only)


def store_sales_stream(events: DataFrame, size_minutes: int = WINDOW_SIZE_MINUTES,
                       advance_minutes: int = WINDOW_ADVANCE_MINUTES,
                       grace_minutes: int = WINDOW_GRACE_MINUTES, time_col: str = "event_time",
                       store_col: str = "storeID", amount_col: str = "totalAmount",
                       keep_window: bool = True) -> DataFrame:
    """Windowed store sales with a watermark of the grace period (``F.window``
    form: state is kept per window and store)."""
    return windowed_store_sales(
        events.withWatermark(time_col, f"{grace_minutes} minutes"), size_minutes,
        advance_minutes, time_col=time_col, store_col=store_col, amount_col=amount_col,
        keep_window=keep_window, method="window")


def store_sales_panes_stream(events: DataFrame, size_minutes: int = WINDOW_SIZE_MINUTES,
                             advance_minutes: int = WINDOW_ADVANCE_MINUTES,
                             grace_minutes: int = WINDOW_GRACE_MINUTES,
                             time_col: str = "event_time", store_col: str = "storeID",
                             amount_col: str = "totalAmount") -> DataFrame:
    """Final totals (append mode) by two chained stateful aggregates: panes of one advance
    step, then the windows over closed panes.

    A record updates one state row, its pane's, instead of size/advance window rows; only
    finished panes are laid out over windows. In exchange lateness is decided per pane: a
    record whose pane has closed is dropped from all its windows, also from those that are
    still open (``store_sales_stream`` adds it to these). On records that come at most the
    grace late the two agree. Run it with ``late_rows_per_window=False``: chained state
    needs Spark's default late-row filter.
    """
    if size_minutes % advance_minutes:
        raise ValueError("panes need the size to be a multiple of the advance")
    step = f"{advance_minutes} minutes"
    panes = (events.withWatermark(time_col, f"{grace_minutes} minutes")
             .select(F.window(time_col, step).alias("_pane"), F.col(store_col).alias(store_col),
                     *money_parts(amount_col))
             .groupBy("_pane", store_col).agg(*part_sums()))
    wide = F.window(F.window_time("_pane"), f"{size_minutes} minutes", step)
    sales = panes.groupBy(wide.alias("_window"), store_col).agg(*part_sums())
    return sales.select(F.col("_window.start").cast("timestamp_ntz").alias("window_start"),
                        F.col("_window.end").cast("timestamp_ntz").alias("window_end"),
                        store_col, total_of().alias("totalSale"))
