"""Intake metrics kept: one row per micro-batch, appended by a query listener."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tillstream.streaming.sinks import read_batches

INTAKE_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("intake_rows", T.LongType()),
    T.StructField("intake_amount", T.DoubleType()),
    T.StructField("null_delivery_type", T.LongType()),
    T.StructField("null_customer_type", T.LongType()),
    T.StructField("home_deliveries", T.LongType()), T.StructField("prime_invoices", T.LongType())])


class IntakeTable(StreamingQueryListener):
    """Stores the observation of every micro-batch (``metrics.observe_intake``) below ``path``.

    A batch's row replaces an earlier one of the same query and batch, so a replay leaves
    one. Use it as a context manager: it listens inside, and on leaving waits until the
    queries that started inside and have ended are stored.
    """

    def __init__(self, spark: SparkSession, path: str, observation: str = "intake"):
        super().__init__()
        self.spark, self.path, self.observation = spark, path, observation
        self.failed: list[Exception] = []
        self._changed = threading.Condition()
        self._started: set[str] = set()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._started.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.observation)
        if seen is None:
            return
        try:
            name = event.progress.name
            row = (name, *[seen[f.name] for f in INTAKE_SCHEMA.fields[1:]])
            self.spark.createDataFrame([row], INTAKE_SCHEMA).coalesce(1).write.mode(
                "overwrite").parquet(f"{self.path}/run={name or event.progress.id}/"
                                     f"batch_id={event.progress.batchId}")
        except Exception as e:  # an exception here would be lost in the listener's thread
            self.failed.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def __enter__(self) -> IntakeTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        active = {str(q.runId) for q in self.spark.streams.active}
        with self._changed:
            done = self._changed.wait_for(lambda: self._started - active <= self._ended, timeout=120)
        self.spark.streams.removeListener(self)
        if error[0] is None:
            if self.failed:
                raise self.failed[0]
            if not done:
                raise TimeoutError("the events of an ended query did not arrive")


def read_intake(spark: SparkSession, path: str) -> DataFrame:
    """query, batch_id and the metrics of every stored micro-batch."""
    schema = T.StructType([*INTAKE_SCHEMA.fields, T.StructField("run", T.StringType())])
    return read_batches(spark, path, schema).drop("run").select(
        "query", F.col("batch_id").cast("bigint").alias("batch_id"),
        *INTAKE_SCHEMA.fieldNames()[1:])
