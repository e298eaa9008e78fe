"""The fan-out job: one invoice stream, four outputs.

* shipment (home deliveries) and hadoop-sink (flattened lines) are stateless:
  one query, one ``foreachBatch`` that persists the batch once and writes both.
* loyalty (keyed aggregate, update mode) and store-sales (hopping windows,
  update mode) are stateful: one query each, each with its own checkpoint.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tillstream.constants import (HADOOP_OUTPUT, INPUT_TOPIC, LOYALTY_OUTPUT, SHIPMENT_OUTPUT,
                                  STORE_SALES_OUTPUT, WINDOW_ADVANCE_MINUTES,
                                  WINDOW_GRACE_MINUTES, WINDOW_SIZE_MINUTES)
from tillstream.operators import stateless, store_sales
from tillstream.operators.metrics import observe_intake
from tillstream.streaming import jobs
from tillstream.schemas import INVOICE_COLUMNS
from tillstream.streaming.loyalty_state import (loyalty_rows, loyalty_stateful,
                                                loyalty_stateful_writer)
from tillstream.streaming.sinks import batch_dir_writer, start, stream_conf, wait_for

OUTPUTS = (SHIPMENT_OUTPUT, HADOOP_OUTPUT, LOYALTY_OUTPUT, STORE_SALES_OUTPUT)


@dataclass
class FanoutPaths:
    root: str
    queries: list = field(default_factory=list)

    def out(self, name: str) -> str:
        return f"{self.root}/out/{name}"

    def ckpt(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def file_writers(paths: FanoutPaths, partition_by: dict | None = None,
                 fmt: str = "parquet") -> dict:
    """Each output to ``root/out/<name>/batch_id=N`` (idempotent per batch);
    ``partition_by`` maps an output name to partition columns, e.g.
    ``{"hadoop-sink": ("storeID",)}`` for a store-partitioned line archive."""
    partition_by = partition_by or {}
    return {name: batch_dir_writer(paths.out(name), fmt, tuple(partition_by.get(name, ())))
            for name in OUTPUTS}


def kafka_writers(servers: str, topics: dict | None = None, value_format: str = "json",
                  schema_ids: dict | None = None, key_schema_id: int | None = None,
                  options: dict | None = None) -> dict:
    """Each output produced to its topic as (key, value).

    ``topics`` renames outputs. ``value_format="avro"`` writes registry-framed
    Avro with the schema ids in ``schema_ids`` (output name -> id) and, with
    ``key_schema_id``, framed Avro keys. ``options`` are further producer
    options (e.g. ``kafka.security.protocol``)."""
    from tillstream.sources.kafka import kafka_batch_writer
    topics = {**{n: n for n in OUTPUTS}, **(topics or {})}
    keys = {LOYALTY_OUTPUT: "customerCardNo", STORE_SALES_OUTPUT: "storeID"}
    out = {}
    for n in OUTPUTS:
        more = {}
        if value_format == "avro":
            more = {"value_format": "avro", "schema_id": (schema_ids or {})[n],
                    "key_schema_id": key_schema_id}
        if options:
            more["options"] = options
        w = kafka_batch_writer(servers, topics[n], **more)
        if n in keys:
            def keyed(batch, batch_id, _w=w, _k=keys[n]):
                _w(batch.withColumn("key", batch[_k]), batch_id)
            out[n] = keyed
        else:
            out[n] = w
    return out


def shipment_records(invoices: DataFrame) -> DataFrame:
    """Home deliveries as plain invoices: key and the invoice's own columns."""
    return stateless.shipment_filter(invoices).select("key", *INVOICE_COLUMNS)


def stateless_writer(writers: dict, outputs: tuple[str, ...] = OUTPUTS):
    def write(batch: DataFrame, batch_id: int):
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if SHIPMENT_OUTPUT in outputs:
                writers[SHIPMENT_OUTPUT](shipment_records(batch), batch_id)
            if HADOOP_OUTPUT in outputs:
                writers[HADOOP_OUTPUT](stateless.hadoop_records(batch, keep=("key",)), batch_id)
        finally:
            batch.unpersist()
    return write


def _loyalty_query(invoices, paths, writers, mode, opts):
    ckpt = paths.ckpt(LOYALTY_OUTPUT)
    if mode == "aggregate":
        # records that carry their place in the topic: the last to arrive is the latest
        arrival = {"partition", "offset"} <= set(invoices.columns)
        return start(jobs.loyalty_updates(invoices, None if arrival else "event_time"), ckpt,
                     "update", writers[LOYALTY_OUTPUT], **opts)
    if mode == "stateful":
        return start(loyalty_stateful(loyalty_rows(invoices)), ckpt, "append",
                     loyalty_stateful_writer(writers[LOYALTY_OUTPUT]), **opts)
    raise ValueError(f"unknown loyalty mode {mode}")


def run_fanout(invoices: DataFrame, root: str, available_now: bool = True,
               trigger_seconds: float = 1.0, timeout_s: float | None = None,
               writers: dict | None = None, state_partitions: int | None = None,
               store_window_bounds: bool = True, loyalty_mode: str = "aggregate",
               observe: bool = True, outputs: tuple[str, ...] = OUTPUTS,
               window_size_minutes: int = WINDOW_SIZE_MINUTES,
               window_advance_minutes: int = WINDOW_ADVANCE_MINUTES,
               grace_minutes: int = WINDOW_GRACE_MINUTES, query_prefix: str | None = None):
    """Start the queries on a streaming invoice DataFrame (with lines,
    ``event_time`` and ``k``). ``root`` holds checkpoints (and file outputs
    when ``writers`` is not given). ``store_window_bounds=False`` emits store
    sales as (storeID, totalSale) only, like the original record.
    ``loyalty_mode``: "aggregate" (keyed aggregate, update-mode changelog) or
    "stateful" (per-record processor: one notification per prime invoice).
    ``outputs`` limits the run to some outputs; ``query_prefix`` names the queries.
    With ``available_now`` the call waits for the queries (without limit; with
    ``timeout_s`` it raises when the limit is reached) and returns the paths;
    otherwise it returns the running queries.
    """
    paths = FanoutPaths(root)
    writers = writers or file_writers(paths)

    def opts(name):
        named = f"{query_prefix}-{name}" if query_prefix else None
        return dict(available_now=available_now, trigger_seconds=trigger_seconds, query_name=named)
    qs = []
    with stream_conf(invoices.sparkSession, state_partitions=state_partitions):
        if SHIPMENT_OUTPUT in outputs or HADOOP_OUTPUT in outputs:
            # intake metrics per micro-batch (query progress / listeners), instead of a log line per record
            observed = observe_intake(invoices, "intake") if observe else invoices
            qs.append(start(observed, paths.ckpt("stateless"), "append",
                            stateless_writer(writers, outputs), **opts("stateless")))
        if LOYALTY_OUTPUT in outputs:
            qs.append(_loyalty_query(invoices, paths, writers, loyalty_mode, opts(LOYALTY_OUTPUT)))
        if STORE_SALES_OUTPUT in outputs:
            sales = jobs.store_sales_stream(
                store_sales.rekey_by_store(invoices), window_size_minutes, window_advance_minutes,
                grace_minutes, keep_window=store_window_bounds)
            qs.append(start(sales, paths.ckpt(STORE_SALES_OUTPUT), "update",
                            writers[STORE_SALES_OUTPUT], **opts(STORE_SALES_OUTPUT)))
        if not available_now:
            return qs
        wait_for(qs, timeout_s)
    paths.queries = qs
    return paths


#: Records of a micro-batch of the service, unless set otherwise: a long topic is read in
#: several batches instead of one that holds all of it. Nothing is dropped.
MAX_OFFSETS_PER_TRIGGER = 5_000_000


def run_fanout_kafka(spark, servers: str, checkpoint_root: str, input_topic: str = INPUT_TOPIC,
                     value_format: str = "json", avro_schema: str | None = None,
                     event_time: str = "timestamp", trigger_seconds: float = 1.0,
                     max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER,
                     key_format: str = "string", store_window_bounds: bool = True,
                     loyalty_mode: str = "aggregate", output_format: str = "json",
                     topics: dict | None = None, schema_ids: dict | None = None,
                     key_schema_id: int | None = None, kafka_options: dict | None = None,
                     query_prefix: str | None = None, **windows):
    """The service form: consume the invoice topic from the earliest offset and
    produce the four output topics continuously (1 s triggers). ``windows`` are
    the window settings of ``run_fanout``; ``kafka_options`` go to source and sinks."""
    from tillstream.sources.adapters import invoices_from_messages
    from tillstream.sources.kafka import kafka_stream
    msgs = kafka_stream(spark, servers, input_topic,
                        max_offsets_per_trigger=max_offsets_per_trigger,
                        min_partitions=spark.sparkContext.defaultParallelism,
                        **(kafka_options or {}))
    inv = invoices_from_messages(msgs, value_format, avro_schema, event_time, key_format)
    writers = kafka_writers(servers, topics, output_format, schema_ids, key_schema_id,
                            kafka_options)
    return run_fanout(inv, checkpoint_root, available_now=False,
                      trigger_seconds=trigger_seconds, writers=writers,
                      store_window_bounds=store_window_bounds, loyalty_mode=loyalty_mode,
                      query_prefix=query_prefix, **windows)
