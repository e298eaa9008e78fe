"""All four outputs of the fan-out as of one point of the input.

One streaming query writes the four outputs of a micro-batch and then a commit record.
Readers take the batches that are committed, in every output, so they never see an
invoice in one output and not in another. A batch that failed half-way is written anew
by its replay; a batch that was committed before the query noted it is left as it is.

The two aggregated outputs are stored as the batch's share (sums per card, sums per store
and pane): these add up over any set of batches, so the query keeps no state, and a cut
needs no more than the sum over its batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillstream.constants import (HADOOP_OUTPUT, LOYALTY_OUTPUT, SHIPMENT_OUTPUT,
                                  STORE_SALES_OUTPUT, WINDOW_ADVANCE_MINUTES,
                                  WINDOW_SIZE_MINUTES)
from tillstream.functions.money import money_parts, part_sums, total_of
from tillstream.operators import store_sales
from tillstream.operators.loyalty import CARD
from tillstream.operators.stateless import (earned_points, hadoop_records, prime_filter,
                                            shipment_filter)
from tillstream.schemas import HADOOP_RECORD, INVOICE_COLUMNS, POS_INVOICE
from tillstream.streaming.sinks import read_batches

KEY = T.StructField("key", T.StringType())
SUMS = [T.StructField("_hi", T.LongType()), T.StructField("_lo", T.LongType()),
        T.StructField("_dec", T.DecimalType(38, 12)), T.StructField("_rest", T.DoubleType())]


def _loyalty_share(invoices: DataFrame) -> DataFrame:
    rows = prime_filter(invoices).select(
        CARD, F.struct(F.col("event_time").cast("timestamp").alias("event_time"), "k",
                       "invoiceNumber", "totalAmount").alias("newest"),
        *money_parts("totalAmount"))
    return rows.groupBy(CARD).agg(F.max("newest").alias("newest"), *part_sums())


def _sales_share(invoices: DataFrame) -> DataFrame:
    return store_sales.pane_sums(invoices, WINDOW_ADVANCE_MINUTES)


def _shares(tie: T.DataType) -> dict[str, tuple[Callable, T.StructType]]:
    """How each output's share of a batch is made, and its schema."""
    newest = T.StructType([T.StructField("event_time", T.TimestampType()), T.StructField("k", tie),
                           T.StructField("invoiceNumber", T.StringType()),
                           T.StructField("totalAmount", T.DoubleType())])
    return {
        SHIPMENT_OUTPUT: (lambda b: shipment_filter(b).select("key", *INVOICE_COLUMNS),
                          T.StructType([KEY, *POS_INVOICE.fields])),
        HADOOP_OUTPUT: (lambda b: hadoop_records(b, keep=("key",)),
                        T.StructType([KEY, *HADOOP_RECORD.fields])),
        LOYALTY_OUTPUT: (_loyalty_share, T.StructType([
            T.StructField(CARD, T.StringType()), T.StructField("newest", newest), *SUMS])),
        STORE_SALES_OUTPUT: (_sales_share, T.StructType([
            T.StructField("storeID", T.StringType()), T.StructField("_pane", T.LongType()), *SUMS])),
    }


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """batch_id of every committed micro-batch."""
    return read_batches(spark, f"{root}/commits", T.StructType([])).select("batch_id").distinct()


def cut_writer(root: str, after_output: Callable[[str, int], None] = lambda name, batch: None):
    """foreachBatch function: the outputs to ``root/out/<name>/batch_id=N``, then the commit
    record ``root/commits/batch_id=N``. ``after_output`` is called after each output."""
    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        if committed_batches(spark, root).where(F.col("batch_id") == batch_id).count():
            return  # replayed after its commit: complete, and possibly being read
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, (share, schema) in _shares(batch.schema["k"].dataType).items():
                columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
                share(batch).select(*columns).write.mode("overwrite").option(
                    "compression", "zstd").parquet(f"{root}/out/{name}/batch_id={batch_id}")
                after_output(name, batch_id)
        finally:
            batch.unpersist()
        spark.range(1).select(F.current_timestamp().alias("committed_at")).write.mode(
            "overwrite").parquet(f"{root}/commits/batch_id={batch_id}")
    return write


def read_share(spark: SparkSession, root: str, name: str,
               tie: T.DataType = T.LongType()) -> DataFrame:
    """What the committed batches hold of one output, with ``batch_id``."""
    schema = _shares(tie)[name][1]
    return read_batches(spark, f"{root}/out/{name}", schema).join(
        committed_batches(spark, root), "batch_id", "left_semi")


def read_cut(spark: SparkSession, root: str, name: str,
             tie: T.DataType = T.LongType()) -> DataFrame:
    """One output as of the last committed batch: shipments and line records as rows, the
    newest notification of each card, the total of each (window, store)."""
    share = read_share(spark, root, name, tie).drop("batch_id")
    if name == LOYALTY_OUTPUT:
        cards = share.groupBy(CARD).agg(F.max("newest").alias("newest"), *part_sums())
        return cards.select("newest.invoiceNumber", CARD, "newest.totalAmount",
                            earned_points(F.col("newest.totalAmount")).alias("earnedLoyaltyPoints"),
                            earned_points(total_of()).alias("totalLoyaltyPoints"))
    if name == STORE_SALES_OUTPUT:
        panes = share.groupBy("storeID", "_pane").agg(*part_sums())
        return store_sales.windows_of_panes(panes, WINDOW_SIZE_MINUTES, WINDOW_ADVANCE_MINUTES)
    return share
