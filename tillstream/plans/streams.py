"""Registered streaming queries. Each runs a bounded (availableNow) stream over
a whole table, most of them in several micro-batches, into the shared checkpoint
folder and returns a batch DataFrame over what the stream wrote."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillstream.constants import (HADOOP_OUTPUT, LOYALTY_OUTPUT, SHIPMENT_OUTPUT,
                                  STORE_SALES_OUTPUT)
from tillstream.functions.money import money_sum
from tillstream.operators import stateless
from tillstream.operators.metrics import observe_intake
from tillstream.plans.catalog import flat_invoice, in_utc
from tillstream.plans.fanout import run_fanout
from tillstream.schemas import NOTIFICATION, POS_INVOICE
from tillstream.session import scratch_path
from tillstream.sources import adapters
from tillstream.sources.codec import (avro_schema_json, decode_avro, decode_avro_key, decode_json,
                                      encode_avro, encode_json)
from tillstream.sources.log import read_log, with_offsets, write_log
from tillstream.streaming import cut, jobs
from tillstream.sources.tables import read_table, table_schema
from tillstream.streaming import loyalty_state
from tillstream.streaming.intake import IntakeTable, read_intake
from tillstream.streaming.loyalty_state import OUTPUT_SCHEMA, loyalty_rows, loyalty_stateful_writer
from tillstream.streaming.sinks import batch_dir_writer, last_emission, read_batches, run_bounded

#: Parts of a table that become micro-batches.
PARTS_OF_TABLE = 4

STORE_OUT = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("storeID", T.StringType()),
    T.StructField("totalSale", T.DoubleType()),
])


def _cuts(spark, sf_dir: str, table: str, order: str, n: int = PARTS_OF_TABLE) -> list[float]:
    """Quantiles of a table's time column, between ``n`` parts of about equal size."""
    at = F.unix_micros(F.col(order).cast("timestamp"))
    return read_table(spark, sf_dir, table).select(at.cast("double").alias("t")).approxQuantile(
        "t", [i / n for i in range(1, n)], 0.01)


def _part_of(time: str, cuts: list[float]) -> F.Column:
    """The part of a row by its time; rows without a time go into the first part."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    return F.coalesce(sum(((at > c).cast("int") for c in cuts), F.lit(0)), F.lit(0))


def _parts(spark, sf_dir: str, table: str, order: str, n: int = PARTS_OF_TABLE) -> list[DataFrame]:
    """The whole table cut into ``n`` parts by a time column."""
    df = read_table(spark, sf_dir, table)
    part = _part_of(order, _cuts(spark, sf_dir, table, order, n))
    return [df.filter(part == i) for i in range(n)]


def _parts_by_key(spark, sf_dir: str, table: str, key: str, n: int = PARTS_OF_TABLE):
    """The whole table cut into ``n`` parts by a key's remainder."""
    df = read_table(spark, sf_dir, table)
    part = F.coalesce(F.pmod(F.col(key), F.lit(n)), F.lit(0))
    return [df.filter(part == i) for i in range(n)]


def _replay(parts: list[DataFrame], name: str, schema, job, mode: str, sink=None,
            root: str | None = None, **run):
    """Run ``job`` over the parts of a table, one part for each micro-batch.

    Each part is appended to the stream's folder and the query is started anew on
    its checkpoint, so every batch after the first continues from stored state.
    Returns what was written, by batch.
    """
    spark = parts[0].sparkSession
    root = root or scratch_path(spark, name)
    sink = sink(root) if sink else batch_dir_writer(f"{root}/out")
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(parts[0].schema).parquet(f"{root}/in")
        run_bounded(job(stream), f"{root}/checkpoint", mode, sink, **run)
    return read_batches(spark, f"{root}/out", schema)


def _loyalty_job(spark, sf_dir):
    return lambda orders: jobs.loyalty_updates(adapters.invoices(
        spark, sf_dir, lines=False, items=False, address=False, orders=orders))


def _sales_job(spark, sf_dir):
    return lambda events: jobs.store_sales_stream(adapters.store_events(spark, sf_dir, events))


@in_utc
def loyalty_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode keyed aggregate over four parts of the orders, one file per trigger;
    final state = last emission per card."""
    root = scratch_path(spark, "loyalty-update")
    for part in _parts(spark, sf_dir, "orders", "o_orderdate"):
        part.write.mode("append").parquet(f"{root}/in")
    orders = (spark.readStream.schema(table_schema(spark, sf_dir, "orders"))
              .option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism)
              .parquet(f"{root}/in"))
    run_bounded(_loyalty_job(spark, sf_dir)(orders), f"{root}/checkpoint", "update",
                batch_dir_writer(f"{root}/out"))
    out = read_batches(spark, f"{root}/out", NOTIFICATION)
    return last_emission(out, ["customerCardNo"]).select(*NOTIFICATION.fieldNames())


@in_utc
def loyalty_restart(spark, sf_dir):
    """The same, stopped and resumed from its checkpoint after every part."""
    out = _replay(_parts(spark, sf_dir, "orders", "o_orderdate"), "loyalty-restart", NOTIFICATION,
                  _loyalty_job(spark, sf_dir), "update")
    return last_emission(out, ["customerCardNo"]).select(*NOTIFICATION.fieldNames())


def _stateful(spark, sf_dir, parts, root: str) -> DataFrame:
    """Run the per-record processor over parts of the orders; its output by batch."""
    def job(orders):
        return loyalty_state.loyalty_stateful(loyalty_rows(adapters.invoices(
            spark, sf_dir, lines=False, items=False, address=False, orders=orders)))
    return _replay(parts, "loyalty-stateful", OUTPUT_SCHEMA, job, "append",
                   lambda r: loyalty_stateful_writer(batch_dir_writer(f"{r}/out")), root)


@in_utc
def loyalty_stateful(spark, sf_dir):
    """Per-record processor over four parts: one notification per prime invoice."""
    out = _stateful(spark, sf_dir, _parts(spark, sf_dir, "orders", "o_orderdate"),
                    scratch_path(spark, "loyalty-stateful"))
    return out.drop("batch_id")


@in_utc
def loyalty_state_snapshot(spark, sf_dir):
    """The state of the stopped per-record processor, read back: each card's total."""
    root = scratch_path(spark, "loyalty-state")
    _stateful(spark, sf_dir, _parts_by_key(spark, sf_dir, "orders", "o_orderkey"), root)
    return loyalty_state.card_totals(spark, f"{root}/checkpoint")


@in_utc
def loyalty_state_at_batch(spark, sf_dir):
    """The same as it stood after the second of four batches."""
    root = scratch_path(spark, "loyalty-state")
    _stateful(spark, sf_dir, _parts_by_key(spark, sf_dir, "orders", "o_orderkey"), root)
    return loyalty_state.card_totals(spark, f"{root}/checkpoint", batch_id=1)


@in_utc
def store_sales_stream_update(spark, sf_dir):
    """Update-mode hopping windows over four parts by time; last emission per (window, store)."""
    out = _replay(_parts(spark, sf_dir, "events", "ts"), "store-sales-update", STORE_OUT,
                  _sales_job(spark, sf_dir), "update")
    return last_emission(out, ["window_start", "window_end", "storeID"])


@in_utc
def store_sales_final_only(spark, sf_dir):
    """Append mode with a watermark: each window once, when it has closed."""
    out = _replay(_parts(spark, sf_dir, "events", "ts"), "store-sales-final", STORE_OUT,
                  _sales_job(spark, sf_dir), "append")
    return out.drop("batch_id")


@in_utc
def store_sales_final_panes(spark, sf_dir):
    """The same by chained aggregates: panes in state, then windows over closed panes."""
    def job(events):
        return jobs.store_sales_panes_stream(adapters.store_events(spark, sf_dir, events))
    out = _replay(_parts(spark, sf_dir, "events", "ts"), "store-sales-panes", STORE_OUT, job,
                  "append", late_rows_per_window=False)
    return out.drop("batch_id")


@in_utc
def store_sales_late(spark, sf_dir):
    """Grace: parts by event id, so that later parts hold late events; each is added to the
    windows that end after the watermark of the parts before, and to no other."""
    events = read_table(spark, sf_dir, "events")
    parts = [events.filter(F.pmod("event_id", F.lit(PARTS_OF_TABLE)) == i)
             for i in range(PARTS_OF_TABLE)]
    out = _replay(parts, "store-sales-late", STORE_OUT, _sales_job(spark, sf_dir), "update")
    return last_emission(out, ["window_start", "window_end", "storeID"])


@in_utc
def invoice_decode_json(spark, sf_dir):
    """Invoices encoded as (key, JSON value) and decoded back with the declared schema."""
    inv = adapters.invoices(spark, sf_dir, lines=True)
    enc = encode_json(inv, [f.name for f in POS_INVOICE.fields])
    dec = decode_json(enc, POS_INVOICE)
    return flat_invoice(dec.withColumn("numberOfItems", F.size("invoiceLineItems")))


@in_utc
def loyalty_encode_json(spark, sf_dir):
    """Loyalty notifications (changelog) as Kafka-shaped (key, value JSON) rows."""
    from tillstream.operators.loyalty import loyalty_changelog
    n = loyalty_changelog(adapters.invoices(spark, sf_dir, lines=False, items=False,
                                             address=False))
    return encode_json(n.withColumn("key", F.col("customerCardNo")),
                       NOTIFICATION.fieldNames())


def _writer_schemas() -> dict[int, str]:
    """Two versions of the invoice: the fields in their order; and in reverse order, with one
    that the reader does not know."""
    newer = T.StructType([T.StructField("terminal", T.IntegerType()), *POS_INVOICE.fields[::-1]])
    return {11: avro_schema_json(POS_INVOICE, "PosInvoice"),
            12: avro_schema_json(newer, "PosInvoice")}


@in_utc
def invoice_decode_avro(spark, sf_dir):
    """Nested invoices as registry-framed Avro, each by one of two writer schemas, decoded
    by the schema of its frame and resolved to the reader's fields by name."""
    schemas = _writer_schemas()
    inv = adapters.invoices(spark, sf_dir, lines=True).withColumn("terminal", F.lit(7))
    fields = [f.name for f in POS_INVOICE.fields]
    encoded = [encode_avro(inv.where(F.col("k") % 2 == i), cols, schema_json=schemas[n], schema_id=n)
               for i, (n, cols) in enumerate(zip(schemas, (fields, ["terminal", *fields])))]
    dec = decode_avro(encoded[0].union(encoded[1]), schemas, reader=POS_INVOICE)
    return flat_invoice(dec.withColumn("numberOfItems", F.size("invoiceLineItems")))


@in_utc
def loyalty_encode_avro(spark, sf_dir):
    """Loyalty notifications as framed Avro with framed keys, read back: key and record."""
    from tillstream.operators.loyalty import loyalty_changelog
    n = loyalty_changelog(adapters.invoices(spark, sf_dir, lines=False, items=False,
                                             address=False))
    schema = avro_schema_json(NOTIFICATION, "Notification")
    sent = encode_avro(n.withColumn("key", F.col("customerCardNo")), NOTIFICATION.fieldNames(),
                       schema_json=schema, schema_id=21, key_schema_id=22)
    return decode_avro(decode_avro_key(sent.withColumnRenamed("key", "key_bytes")),
                       {21: schema}, reader=NOTIFICATION)


@in_utc
def fanout_counts(spark, sf_dir):
    """Run the four-output fan-out on the invoice stream; rows per output (final
    state for the two changelog outputs)."""
    inv = _invoice_stream(spark, sf_dir)
    paths = run_fanout(inv, scratch_path(spark, "fanout"))
    ship = spark.read.parquet(paths.out(SHIPMENT_OUTPUT))
    hadoop = spark.read.parquet(paths.out(HADOOP_OUTPUT))
    loy = last_emission(spark.read.parquet(paths.out(LOYALTY_OUTPUT)), ["customerCardNo"])
    st = last_emission(spark.read.parquet(paths.out(STORE_SALES_OUTPUT)),
                       ["window_start", "window_end", "storeID"])
    parts = [(SHIPMENT_OUTPUT, ship), (HADOOP_OUTPUT, hadoop), (LOYALTY_OUTPUT, loy),
             (STORE_SALES_OUTPUT, st)]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("output"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def _invoice_stream(spark, sf_dir, in_time: bool = True) -> DataFrame:
    """Whole invoices as a stream, as the service receives them, in about four micro-batches;
    with ``in_time`` each holds a part of them by event time, the earliest first.

    The tables are joined once, not in every micro-batch of every output.
    """
    root = scratch_path(spark, "invoices-in")
    inv = adapters.invoices(spark, sf_dir, lines=True)
    if in_time:
        cuts = _cuts(spark, sf_dir, "orders", "o_orderdate")
        path = scratch_path(spark, "invoices")
        parted = inv.withColumn("_part", _part_of("event_time", cuts))
        parted.write.partitionBy("_part").option("compression", "zstd").parquet(path)
        parts = [spark.read.schema(parted.schema).parquet(path).filter(F.col("_part") == i).drop("_part")
                 for i in range(PARTS_OF_TABLE)]
    else:
        parts = [inv]
    for part in parts:
        part.write.mode("append").option("compression", "zstd").parquet(root)
    files = len(spark.read.parquet(root).inputFiles())
    return (spark.readStream.schema(inv.schema)
            .option("maxFilesPerTrigger", max(1, files // PARTS_OF_TABLE)).parquet(root))


def _fanout_output(spark, sf_dir, name: str) -> DataFrame:
    """The rows that the fan-out over the invoice stream writes to one output."""
    # only store sales have a watermark: the other outputs are the same in any order
    inv = _invoice_stream(spark, sf_dir, in_time=name == STORE_SALES_OUTPUT)
    paths = run_fanout(inv, scratch_path(spark, f"fanout-{name}"), outputs=(name,))
    return spark.read.parquet(paths.out(name))


@in_utc
def fanout_shipment(spark, sf_dir):
    rows = _fanout_output(spark, sf_dir, SHIPMENT_OUTPUT)
    return flat_invoice(rows)


@in_utc
def fanout_hadoop(spark, sf_dir):
    return _fanout_output(spark, sf_dir, HADOOP_OUTPUT).drop("batch_id")


@in_utc
def fanout_loyalty(spark, sf_dir):
    out = last_emission(_fanout_output(spark, sf_dir, LOYALTY_OUTPUT), ["customerCardNo"])
    return out.select(*NOTIFICATION.fieldNames())


@in_utc
def fanout_store_sales(spark, sf_dir):
    return last_emission(_fanout_output(spark, sf_dir, STORE_SALES_OUTPUT),
                         ["window_start", "window_end", "storeID"])


class OutputFailure(RuntimeError):
    """Raised on purpose between two outputs."""


@in_utc
def fanout_consistent_cut(spark, sf_dir):
    """All four outputs as of one committed batch: rows and amount of each.

    Four batches; the third fails between two outputs and is replayed, the fourth fails
    there and is not, so no output shows any of it.
    """
    root = scratch_path(spark, "cut")
    failures = {2: 1, 3: 1}

    def fail(name: str, batch_id: int):
        if name == HADOOP_OUTPUT and failures.get(batch_id, 0):
            failures[batch_id] -= 1
            raise OutputFailure(f"batch {batch_id} after {name}")
    lines = _parts_by_key(spark, sf_dir, "lineitem", "l_orderkey")  # of each batch's orders only
    for number, part in enumerate(_parts_by_key(spark, sf_dir, "orders", "o_orderkey")):
        part.write.mode("append").parquet(f"{root}/in")
        for attempt in range(1 if number == 3 else 2):
            orders = spark.readStream.schema(part.schema).parquet(f"{root}/in")
            inv = adapters.invoices(spark, sf_dir, lines=True, orders=orders, lineitem=lines[number])
            try:
                run_bounded(inv, f"{root}/checkpoint", "append", cut.cut_writer(root, fail))
                break
            except StreamingQueryException as e:
                if OutputFailure.__name__ not in str(e):
                    raise
    amount = {SHIPMENT_OUTPUT: "totalAmount", HADOOP_OUTPUT: "totalValue",
              LOYALTY_OUTPUT: "totalAmount", STORE_SALES_OUTPUT: "totalSale"}
    out = None
    for name, column in amount.items():
        own = cut.read_cut(spark, root, name).agg(
            F.count(F.lit(1)).alias("rows"), money_sum(column).alias("amount"))
        own = own.select(F.lit(name).alias("output"), "rows", "amount")
        out = own if out is None else out.unionByName(own)
    return out


@in_utc
def intake_progress(spark, sf_dir):
    """Intake metrics of every micro-batch of a four-part run, as a listener stored them."""
    root = scratch_path(spark, "intake")

    def job(orders):
        return observe_intake(adapters.invoices(spark, sf_dir, lines=False, items=False,
                                                address=False, orders=orders))
    with IntakeTable(spark, f"{root}/table"):
        _replay(_parts_by_key(spark, sf_dir, "orders", "o_orderkey"), "intake", NOTIFICATION, job,
                "append", lambda r: ("noop", r), root)
    return read_intake(spark, f"{root}/table").drop("query")


@in_utc
def partition_replay(spark, sf_dir):
    """One partition of a log of notifications, keyed by card, read from offset 0."""
    rows = stateless.notification(adapters.invoices(
        spark, sf_dir, lines=False, items=False, address=False), keep=("key", "event_time", "k"))
    rows = rows.withColumn("partition", F.pmod(F.col("key").cast("bigint"), F.lit(3)).cast("int"))
    day = F.floor(F.unix_micros(F.col("event_time").cast("timestamp")) / F.lit(86_400_000_000))
    path = scratch_path(spark, "log")
    write_log(with_offsets(rows, ["event_time", "k"], day), path)
    return read_log(spark, path, partition=0).select(
        "partition", "offset", "key", "invoiceNumber", "totalAmount", "earnedLoyaltyPoints")


STREAM_QUERIES = {
    "loyalty_stream_update": loyalty_stream_update,
    "loyalty_restart": loyalty_restart,
    "loyalty_stateful": loyalty_stateful,
    "loyalty_state_snapshot": loyalty_state_snapshot,
    "loyalty_state_at_batch": loyalty_state_at_batch,
    "store_sales_stream_update": store_sales_stream_update,
    "store_sales_final_only": store_sales_final_only,
    "store_sales_final_panes": store_sales_final_panes,
    "store_sales_late": store_sales_late,
    "invoice_decode_json": invoice_decode_json,
    "loyalty_encode_json": loyalty_encode_json,
    "invoice_decode_avro": invoice_decode_avro,
    "loyalty_encode_avro": loyalty_encode_avro,
    "fanout_counts": fanout_counts,
    "fanout_shipment": fanout_shipment,
    "fanout_hadoop": fanout_hadoop,
    "fanout_loyalty": fanout_loyalty,
    "fanout_store_sales": fanout_store_sales,
    "fanout_consistent_cut": fanout_consistent_cut,
    "intake_progress": intake_progress,
    "partition_replay": partition_replay,
}
