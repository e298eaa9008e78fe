"""Store sales over event-time windows (re-key by store, windowed sum).

Batch inputs use a pane rewrite: rows are summed into panes of one advance
step first (one partial aggregate over the raw rows), and only the pane
totals are fanned out to the size/advance windows that cover them. The
direct ``F.window`` form expands every raw row into size/advance copies
before aggregating; streams use it because their state is per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.constants import WINDOW_ADVANCE_MINUTES, WINDOW_SIZE_MINUTES
from tillstream.functions.money import PARTS, money_parts, part_sums, total_of


def rekey_by_store(df: DataFrame, store_col: str = "storeID") -> DataFrame:
    """Message key := store id. No shuffle here; the later groupBy partitions on it."""
    return df.withColumn("key", F.col(store_col))


def _window_frame(start: F.Column, end: F.Column, keep_window: bool, store: str,
                  total: F.Column) -> list:
    cols = [store, total.alias("totalSale")]
    if keep_window:
        cols = [start.cast("timestamp_ntz").alias("window_start"),
                end.cast("timestamp_ntz").alias("window_end")] + cols
    return cols


def windowed_store_sales(df: DataFrame, size_minutes: int = WINDOW_SIZE_MINUTES,
                         advance_minutes: int = WINDOW_ADVANCE_MINUTES,
                         time_col: str = "event_time", store_col: str = "storeID",
                         amount_col: str = "totalAmount", keep_window: bool = True,
                         method: str = "auto") -> DataFrame:
    """Sum of amounts per (window, store); windows are epoch aligned, [start, end).

    ``method``: "panes" (batch only, needs size % advance == 0), "window"
    (``F.window``), or "auto" (panes for batch when possible).
    Output: window_start, window_end (TIMESTAMP_NTZ, UTC), storeID, totalSale.
    A group whose amounts are all null sums to 0.0.
    """
    if size_minutes % advance_minutes and method == "panes":
        raise ValueError("pane rewrite needs size to be a multiple of advance")
    use_panes = method == "panes" or (
        method == "auto" and not df.isStreaming and size_minutes % advance_minutes == 0)
    if use_panes:
        return _store_sales_panes(df, size_minutes, advance_minutes, time_col, store_col,
                                  amount_col, keep_window)
    size, adv = f"{size_minutes} minutes", f"{advance_minutes} minutes"
    w = F.window(time_col, size) if size == adv else F.window(time_col, size, adv)
    agg = (df.select(w.alias("window"), F.col(store_col).alias(store_col),
                     *money_parts(amount_col))
           .groupBy("window", store_col).agg(*part_sums()))
    return agg.select(*_window_frame(F.col("window.start"), F.col("window.end"), keep_window,
                                     store_col, total_of()))


def pane_sums(df: DataFrame, advance_minutes: int = WINDOW_ADVANCE_MINUTES,
              time_col: str = "event_time", store_col: str = "storeID",
              amount_col: str = "totalAmount") -> DataFrame:
    """Parts of the total per store and pane (``_pane`` numbers the advance steps)."""
    pane_ms = advance_minutes * 60_000
    rows = df.select(F.col(store_col).alias(store_col),
                     F.floor(F.unix_millis(F.col(time_col).cast("timestamp")) / F.lit(pane_ms))
                     .alias("_pane"),
                     *money_parts(amount_col))
    return rows.groupBy(store_col, "_pane").agg(*part_sums())


def windows_of_panes(panes: DataFrame, size_minutes: int = WINDOW_SIZE_MINUTES,
                     advance_minutes: int = WINDOW_ADVANCE_MINUTES, store_col: str = "storeID",
                     keep_window: bool = True) -> DataFrame:
    """Totals per (window, store) of pane sums (one row per store and pane)."""
    pane_ms = advance_minutes * 60_000
    n = size_minutes // advance_minutes
    start = F.timestamp_millis(F.col("_wpane") * F.lit(pane_ms))
    end = F.timestamp_millis((F.col("_wpane") + F.lit(n)) * F.lit(pane_ms))
    if n == 1:  # tumbling: a pane is a window, one aggregate
        agg = panes.withColumnRenamed("_pane", "_wpane")
    else:
        # each pane belongs to the n windows starting at pane-n+1 .. pane
        fanned = panes.select(store_col, *PARTS,
                              F.explode(F.sequence(F.col("_pane") - F.lit(n - 1), F.col("_pane")))
                              .alias("_wpane"))
        agg = fanned.groupBy(store_col, "_wpane").agg(*part_sums())
    return agg.select(*_window_frame(start, end, keep_window, store_col, total_of()))


def _store_sales_panes(df, size_minutes, advance_minutes, time_col, store_col, amount_col,
                       keep_window):
    panes = pane_sums(df, advance_minutes, time_col, store_col, amount_col)
    return windows_of_panes(panes, size_minutes, advance_minutes, store_col, keep_window)


def hopping_store_sales(df: DataFrame, **kw) -> DataFrame:
    """The configured hopping window (60 min, advancing by 5 min)."""
    return windowed_store_sales(df, WINDOW_SIZE_MINUTES, WINDOW_ADVANCE_MINUTES, **kw)


def tumbling_store_sales(df: DataFrame, size_minutes: int = WINDOW_SIZE_MINUTES, **kw) -> DataFrame:
    """Tumbling window: advance equal to size."""
    return windowed_store_sales(df, size_minutes, size_minutes, **kw)


def unwindowed(df: DataFrame) -> DataFrame:
    """Unwrap the windowed key: keep only storeID and totalSale (bounds dropped)."""
    return df.select("storeID", "totalSale")


def closed_windows(df: DataFrame, watermark) -> DataFrame:
    """Final-only view of a windowed result: windows whose end is at or before the watermark."""
    return df.where(F.col("window_end") <= watermark)
