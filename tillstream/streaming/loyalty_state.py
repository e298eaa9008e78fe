"""Per-record loyalty processing: one notification per input invoice, carrying
the card's running total over everything that arrived before it.

The card's total lives in Spark's state store (RocksDB), in the value state
``total`` of a ``transformWithState`` operator, named and checkpointed with the
query. One streaming query has two branches over the same micro-batch:

* the invoices' amounts are summed per card within every Arrow batch, so a hot card
  reaches its state as a few rows; the processor returns the total before the batch
  and stores the total after it. Only cards of the micro-batch are read;
* the invoices themselves pass by without state.

``foreachBatch`` joins the two: the running total inside the batch, in (event time,
tie key) order, comes from the skew-safe batch ``running_total``, on the JVM, plus the
card's total before. Rows of a later batch are thus added after everything earlier
(arrival order), as a per-record processor would. A replayed batch starts from the
same state version, and replaces its own output.

``card_totals`` reads the state of a stopped stream back, as of any retained batch.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillstream.functions.money import PARTS, money_parts, total_of
from tillstream.operators.loyalty import BATCH_BUCKET_US, CARD, running_points
from tillstream.operators.running import plus
from tillstream.operators.stateless import earned_points, prime_filter
from tillstream.schemas import NOTIFICATION as OUTPUT_SCHEMA

#: Name of the value state that holds a card's total.
TOTAL_STATE = "total"
TOTAL_SCHEMA = T.StructType([
    T.StructField("_hi", T.LongType()), T.StructField("_lo", T.LongType()),
    T.StructField("_dec", T.DecimalType(38, 12)), T.StructField("_rest", T.DoubleType())])
SUMS_SCHEMA = T.StructType([T.StructField(CARD, T.StringType()), *TOTAL_SCHEMA.fields])
_EXACT = decimal.Context(prec=60)


def loyalty_rows(invoices: DataFrame, time_col: str = "event_time", tie_col: str = "k",
                 prime_only: bool = True) -> DataFrame:
    """The columns of the invoices that the processor needs."""
    src = prime_filter(invoices) if prime_only else invoices
    return src.select(CARD, "invoiceNumber", "totalAmount",
                      F.col(time_col).cast("timestamp").alias("event_time"),
                      F.col(tie_col).alias("tie"))


def _added(a, b):
    """Sum of two parts; null counts as nothing."""
    if a is None or b is None:
        return b if a is None else a
    return _EXACT.add(a, b) if isinstance(a, decimal.Decimal) else a + b


class CardTotal(StatefulProcessor):
    """Gives the total of a card before the micro-batch and stores the total after it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState(TOTAL_STATE, TOTAL_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = tuple(self.total.get()) if self.total.exists() else (None,) * len(PARTS)
        after = before
        for r in rows:
            after = tuple(_added(a, r[p]) for a, p in zip(after, PARTS))
        self.total.update(after)
        yield Row(**{CARD: key[0], **dict(zip(PARTS, before))})

    def close(self) -> None:
        pass


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per card of each Arrow batch."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(CARD, use_threads=False).aggregate(
            [(p, "sum") for p in PARTS])
        t = t.select([CARD, *[f"{p}_sum" for p in PARTS]]).rename_columns([CARD, *PARTS])
        yield from t.cast(b.schema).to_batches()


def loyalty_stateful(rows: DataFrame) -> DataFrame:
    """The streaming frame to run with ``loyalty_stateful_writer`` (append mode): the rows of
    ``loyalty_rows``, and one row per card of the micro-batch with its total before."""
    sums = rows.select(CARD, *money_parts("totalAmount")).mapInArrow(_summed, SUMS_SCHEMA)
    before = sums.groupBy(CARD).transformWithState(CardTotal(), SUMS_SCHEMA, "Append", "None")

    def nothing(fields):
        return [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    own = [f for f in rows.schema.fields if f.name != CARD]
    return rows.select(CARD, *[f.name for f in own], *nothing(TOTAL_SCHEMA),
                       F.lit(False).alias("is_total")).unionByName(
        before.select(CARD, *nothing(own), *PARTS, F.lit(True).alias("is_total")))


def notifications_of_batch(batch: DataFrame) -> DataFrame:
    """Prior total plus running total inside the batch."""
    rows = batch.where(~F.col("is_total")).drop("is_total", *PARTS)
    prior = batch.where("is_total").select(F.col(CARD).alias("_card"), *[
        F.col(p).alias(f"prior{p}") for p in PARTS])
    run = running_points(rows, "event_time", "tie", BATCH_BUCKET_US)
    both = run.join(prior, run[CARD].eqNullSafe(prior["_card"]), "left")
    kinds = {f.name: f.dataType for f in TOTAL_SCHEMA}

    def added(p: str):
        zero = F.lit(0).cast(kinds[p])
        return plus(F.coalesce(f"run_{p}", zero), F.coalesce(f"prior{p}", zero), kinds[p])
    return both.select("invoiceNumber", CARD, "totalAmount",
                       *[added(p).alias(f"sum{p}") for p in PARTS]).select(
        "invoiceNumber", CARD, "totalAmount", earned_points().alias("earnedLoyaltyPoints"),
        earned_points(total_of("sum")).alias("totalLoyaltyPoints"))


def loyalty_stateful_writer(write):
    """Wrap a foreachBatch function so it receives finished notifications."""
    def run(batch: DataFrame, batch_id: int):
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(notifications_of_batch(batch), batch_id)
        finally:
            batch.unpersist()
    return run


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: operatorId, operatorName, stateStoreName,
    numPartitions, minBatchId, maxBatchId."""
    return spark.read.format("state-metadata").load(checkpoint)


def card_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """customerCardNo and totalLoyaltyPoints held by the state of a stopped stream, after its
    last batch or after ``batch_id``."""
    reader = spark.read.format("statestore").option("path", checkpoint).option(
        "stateVarName", TOTAL_STATE)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load()
    return state.select(F.col(f"key.{CARD}").alias(CARD),
                        *[F.col(f"value.{p}").alias(p) for p in PARTS]).select(
        CARD, earned_points(total_of()).alias("totalLoyaltyPoints"))


__all__ = ["OUTPUT_SCHEMA", "card_totals", "loyalty_rows", "loyalty_stateful",
           "loyalty_stateful_writer", "notifications_of_batch", "state_operators"]
