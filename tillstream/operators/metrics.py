"""Intake observation: counts and sums of the input, instead of per-record logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tillstream.functions.money import money_sum
from tillstream.functions.predicates import is_home_delivery, is_prime


def intake_exprs() -> list:
    return [
        F.count(F.lit(1)).alias("intake_rows"),
        money_sum("totalAmount").alias("intake_amount"),
        F.count(F.when(F.col("deliveryType").isNull(), 1)).alias("null_delivery_type"),
        F.count(F.when(F.col("customerType").isNull(), 1)).alias("null_customer_type"),
        F.count(F.when(is_home_delivery(), 1)).alias("home_deliveries"),
        F.count(F.when(is_prime(), 1)).alias("prime_invoices"),
    ]


def observe_intake(df: DataFrame, name: str | Observation = "intake"):
    """Attach the intake metrics to a (batch or streaming) DataFrame.

    Batch: pass an ``Observation`` and read ``.get`` after an action.
    Streaming: pass a name; values arrive in ``StreamingQueryListener``
    progress events (``observedMetrics``) once per micro-batch.
    """
    return df.observe(name, *intake_exprs())


def intake_summary(df: DataFrame) -> DataFrame:
    """The same metrics as a one-row aggregate (partial + final, no skew)."""
    return df.agg(*intake_exprs())
