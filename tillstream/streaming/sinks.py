"""Stream sinks and a runner for bounded (availableNow) or continuous runs."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillstream.session import session_conf

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def batch_dir_writer(path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()):
    """foreachBatch function writing batch N to ``path/batch_id=N`` in overwrite
    mode: a replayed batch replaces its own output (idempotent), and update-mode
    changelogs can be written to files (the file sink has no update mode)."""
    def write(batch: DataFrame, batch_id: int):
        w = batch.write.mode("overwrite")
        if fmt == "parquet":
            w = w.option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def start(df: DataFrame, checkpoint: str, output_mode: str = "append", sink=None,
          query_name: str | None = None, available_now: bool = True,
          trigger_seconds: float = 1.0):
    """Start a streaming query: a foreachBatch function or a (format, path) sink."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=f"{trigger_seconds} seconds")
    if callable(sink):
        w = w.foreachBatch(sink)
    elif isinstance(sink, tuple):
        fmt, path = sink
        w = w.format(fmt).option("path", path)
    return w.start()


def stream_conf(spark: SparkSession, late_rows_per_window: bool = True,
                state_partitions: int | None = None):
    """Settings for stateful stream runs: RocksDB state, and late-row filtering with
    the current watermark so a late row is dropped per window whose end plus the
    grace is at or before stream time.

    State partitions (= shuffle partitions at a checkpoint's first start, fixed
    afterwards) default to the cluster's parallelism: one state partition per
    core, instead of a batch-oriented session setting.
    """
    n = state_partitions or spark.sparkContext.defaultParallelism
    conf = {"spark_sql_streaming_stateStore_providerClass": ROCKSDB,
            "spark_sql_shuffle_partitions": str(n)}
    if late_rows_per_window:
        conf["spark_sql_streaming_statefulOperator_allowMultiple"] = "false"
    return session_conf(spark, **conf)


def wait_for(queries: list, timeout_s: float | None = None) -> None:
    """Wait until all queries have ended: without limit, or raise when a limit is reached.

    Whatever happens, no query is left running; a query's failure is raised.
    """
    end = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        for q in queries:
            if end is None:
                q.awaitTermination()
            elif not q.awaitTermination(max(0.001, end - time.monotonic())):
                raise TimeoutError(f"stream not finished after {timeout_s} s; its output is incomplete")
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def run_bounded(df: DataFrame, checkpoint: str, output_mode: str, sink,
                timeout_s: float | None = None, late_rows_per_window: bool = True,
                state_partitions: int | None = None):
    """Run a stream over everything available now and wait for it to finish
    (without limit; with ``timeout_s`` a TimeoutError is raised when it is reached)."""
    with stream_conf(df.sparkSession, late_rows_per_window, state_partitions):
        q = start(df, checkpoint, output_mode, sink)
        wait_for([q], timeout_s)
    return q


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read what ``batch_dir_writer`` wrote (with a batch_id column), or an empty frame."""
    from pyspark.errors import AnalysisException
    full = T.StructType(list(schema.fields) + [T.StructField("batch_id", T.LongType())])
    try:
        df = spark.read.schema(full).parquet(path)
        df.schema  # resolves the path: a stream that emitted nothing wrote no folder
        return df
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def last_emission(df: DataFrame, keys: list[str]) -> DataFrame:
    """Latest emitted row per key of a changelog (highest batch id).

    A key is emitted at most once per batch, so each column's value at the
    highest batch id is one row: one ``max_by`` per column. Partial + final
    aggregate (hash based when the values are fixed-width, as for store
    sales); hot keys are combined map-side."""
    vals = [c for c in df.columns if c not in keys and c != "batch_id"]
    return df.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in vals])
