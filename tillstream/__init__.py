"""tillstream: point-of-sale invoice analytics on Spark DataFrames and Structured Streaming.

Every operator accepts a batch or a streaming DataFrame unless documented
otherwise; the same code serves backfill and live processing.
"""

from tillstream.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
__version__ = "0.1.0"
