"""Structured Streaming jobs: keyed aggregates in update/append mode, the
per-record loyalty processor, sinks and the multi-output fan-out."""

from tillstream.streaming.jobs import loyalty_updates, store_sales_stream
from tillstream.streaming.loyalty_state import card_totals, loyalty_rows, loyalty_stateful, loyalty_stateful_writer
from tillstream.streaming.sinks import batch_dir_writer, last_emission, run_bounded, start, wait_for

__all__ = ["loyalty_updates", "store_sales_stream", "loyalty_stateful",
           "loyalty_stateful_writer", "loyalty_rows", "card_totals",
           "batch_dir_writer", "last_emission", "run_bounded", "start", "wait_for"]
