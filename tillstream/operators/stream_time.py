"""Store sales by the stream time of the records themselves.

Stream time is the greatest event time among the records of a stream partition up
to and including a record, in order of arrival; it moves with every record, not
between micro-batches. On tables it is a prefix maximum (``operators.running``), so
lateness, the changelog at commit ticks and the release of closed windows are exact
and independent of batching:

* a record counts in a window iff the window's end plus the grace is after the
  record's stream time;
* at each commit tick, every (window, store) that the tick's records touched is
  emitted with its total so far;
* a window is released by the first record whose stream time reaches its end plus
  the grace.

Records are summed into panes of one advance step first (map-side). A record of pane
p counts in the windows that end in panes ``first`` .. p + size/advance, where
``first`` is p + 1, or later for a late record; so partial sums are kept per (store,
pane, first[, tick]) and only these are laid out over windows.

A null event time moves nothing and counts in no window; null amounts count as nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.constants import (WINDOW_ADVANCE_MINUTES, WINDOW_GRACE_MINUTES,
                                  WINDOW_SIZE_MINUTES)
from tillstream.functions.money import PARTS, money_parts, part_sums, total_of
from tillstream.operators.running import prefix

MINUTE_US = 60_000_000
#: Width of the time buckets in the search for the record that closes a window.
CLOSING_BUCKET_US = 24 * 60 * MINUTE_US


def with_stream_time(records: DataFrame, bucket: int, arrival: str = "arrival", tie: str = "k",
                     partition: str = "partition", time_col: str = "event_time") -> DataFrame:
    """Adds ``stream_time`` (BIGINT epoch microseconds; null before the first event time).

    Records arrive in the order of (``arrival``, ``tie``) within a ``partition``; arrival is
    a whole number, such as an offset or a time. ``bucket`` is the span of arrivals whose
    records of one partition a task sorts.
    """
    timed = records.withColumn("stream_time", F.unix_micros(F.col(time_col).cast("timestamp")))
    out = prefix(timed, [partition], [arrival, tie], {"stream_time": "max"},
                 F.floor(F.col(arrival) / F.lit(bucket)), out="_run_")
    return out.withColumn("stream_time", F.col("_run_stream_time")).drop("_run_stream_time")


def _panes(records: DataFrame, size: int, advance: int, grace: int, time_col: str,
           more: list[Column]) -> DataFrame:
    """Rows with the parts of their amount, their pane and the first pane in which a window
    that still takes them ends; records that no window takes are left out."""
    step = advance * MINUTE_US
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    pane = F.floor(at / F.lit(step))
    # a window that ends in pane e (at e * step) takes the record iff e * step + grace > stream time
    open_from = F.floor((F.col("stream_time") - F.lit(grace * MINUTE_US)) / F.lit(step)) + 1
    rows = records.select("storeID", pane.alias("_pane"),
                          F.greatest(pane + 1, open_from).alias("_first"),
                          *money_parts("totalAmount"), *more)
    return rows.where(F.col("_first") <= F.col("_pane") + F.lit(size // advance))


def _laid_out(panes: DataFrame, size: int, advance: int) -> DataFrame:
    """Partial sums laid out over the windows (numbered by the pane in which they end)."""
    ends = F.sequence(F.col("_first"), F.col("_pane") + F.lit(size // advance))
    return panes.select(*[c for c in panes.columns if c not in ("_pane", "_first")],
                        F.explode(ends).alias("_end"))


def _bounds(size: int, advance: int) -> list[Column]:
    step = advance * MINUTE_US
    end = F.col("_end") * F.lit(step)
    return [F.timestamp_micros(end - F.lit(size * MINUTE_US)).cast("timestamp_ntz")
            .alias("window_start"), F.timestamp_micros(end).cast("timestamp_ntz")
            .alias("window_end")]


def _checked(size: int, advance: int) -> None:
    if size % advance:
        raise ValueError("panes need the size to be a multiple of the advance")


def graced_store_sales(records: DataFrame, size_minutes: int = WINDOW_SIZE_MINUTES,
                       advance_minutes: int = WINDOW_ADVANCE_MINUTES,
                       grace_minutes: int = WINDOW_GRACE_MINUTES,
                       time_col: str = "event_time") -> DataFrame:
    """Totals per (window, store) without the records that came too late for a window.
    ``records`` have ``stream_time`` (see ``with_stream_time``)."""
    _checked(size_minutes, advance_minutes)
    panes = _panes(records, size_minutes, advance_minutes, grace_minutes, time_col, [])
    sums = panes.groupBy("storeID", "_pane", "_first").agg(*part_sums())
    totals = _laid_out(sums, size_minutes, advance_minutes).groupBy("storeID", "_end").agg(
        *part_sums())
    return totals.select(*_bounds(size_minutes, advance_minutes), "storeID",
                         total_of().alias("totalSale"))


def store_sales_changelog(records: DataFrame, tick: Column,
                          size_minutes: int = WINDOW_SIZE_MINUTES,
                          advance_minutes: int = WINDOW_ADVANCE_MINUTES,
                          grace_minutes: int = WINDOW_GRACE_MINUTES,
                          time_col: str = "event_time") -> DataFrame:
    """Every emission of the changelog: tick, window, store and the total at that tick.

    ``tick`` numbers the commit intervals; it must not fall in order of arrival. Records
    are summed per (store, pane, first, tick), the sums laid out over the windows they
    touch (no more rows than emissions, but for sums that meet in one), and a (window,
    store)'s sums are added up over its ticks.
    """
    _checked(size_minutes, advance_minutes)
    panes = _panes(records, size_minutes, advance_minutes, grace_minutes, time_col,
                   [tick.cast("bigint").alias("tick")])
    sums = panes.groupBy("storeID", "_pane", "_first", "tick").agg(*part_sums())
    touched = _laid_out(sums, size_minutes, advance_minutes).groupBy(
        "storeID", "_end", "tick").agg(*part_sums())
    upto = (Window.partitionBy("storeID", "_end").orderBy("tick")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = touched.select("storeID", "_end", "tick",
                         *[F.sum(p).over(upto).alias(p) for p in PARTS])
    return run.select("tick", *_bounds(size_minutes, advance_minutes), "storeID",
                      total_of().alias("totalSale"))


def suppressed_store_sales(records: DataFrame, size_minutes: int = WINDOW_SIZE_MINUTES,
                           advance_minutes: int = WINDOW_ADVANCE_MINUTES,
                           grace_minutes: int = WINDOW_GRACE_MINUTES,
                           time_col: str = "event_time", arrival: str = "arrival",
                           tie: str = "k", partition: str = "partition") -> DataFrame:
    """Each closed window once, with its final total and the record that released it:
    ``released_by`` (the tie key) and ``released_at`` (its arrival). Windows that no record
    closes are not emitted. A store's records share one partition.

    The closing record is found by an as-of search: among the records at which stream
    time rises, the one of least arrival whose stream time reaches the window's end plus
    grace. Windows and rises are ordered by falling time, and a prefix minimum over the
    rises' arrivals gives each window its record.
    """
    step, grace = advance_minutes * MINUTE_US, grace_minutes * MINUTE_US
    panes = _panes(records, size_minutes, advance_minutes, grace_minutes, time_col,
                   [F.col(partition).alias("_partition")])
    sums = panes.groupBy("_partition", "storeID", "_pane", "_first").agg(*part_sums())
    totals = _laid_out(sums, size_minutes, advance_minutes).groupBy(
        "_partition", "storeID", "_end").agg(*part_sums())
    # one row for each stream time: the first record that reaches it
    rises = records.where(F.col("stream_time").isNotNull()).groupBy(
        F.col(partition).alias("_partition"), F.col("stream_time").alias("_at")).agg(
        F.min(F.struct(arrival, tie)).alias("_record"))
    closing = totals.select("_partition", "_end").distinct().select(
        "_partition", (F.col("_end") * F.lit(step) + F.lit(grace)).alias("_at"), "_end")
    kind = rises.schema["_record"].dataType
    both = rises.select("_partition", "_at", F.lit(None).cast("bigint").alias("_end"), "_record")
    both = both.unionByName(closing.select(
        "_partition", "_at", "_end", F.lit(None).cast(kind).alias("_record")))
    # falling time; a rise at a window's very moment closes it, so rises come first
    found = prefix(both.withColumn("_falling", -F.col("_at")), ["_partition"],
                   ["_falling", F.col("_end").isNotNull()], {"_record": "min"},
                   F.floor(F.col("_falling") / F.lit(CLOSING_BUCKET_US)))
    released = found.where(F.col("_end").isNotNull() & F.col("run__record").isNotNull()).select(
        F.col("_partition").alias("_p"), F.col("_end").alias("_e"),
        F.col(f"run__record.{tie}").alias("released_by"),
        F.col(f"run__record.{arrival}").alias("released_at"))
    return totals.join(released, totals["_partition"].eqNullSafe(released["_p"])
                       & (totals["_end"] == released["_e"])).select(
        *_bounds(size_minutes, advance_minutes), "storeID", total_of().alias("totalSale"),
        "released_by", "released_at")
