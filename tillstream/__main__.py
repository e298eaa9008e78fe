"""Command line: run the fan-out as a long-running job.

    python -m tillstream fanout --kafka host:9092 --checkpoint hdfs:///chk/invoice-fanout
    python -m tillstream fanout --messages /data/pos-invoice/ --out /data/pos-out \\
        --checkpoint /data/chk --available-now

Kafka mode consumes ``pos-invoice`` from the earliest offset and produces
``shipment``, ``hadoop-sink``, ``loyalty`` and ``store-sales``; message mode
reads JSON lines with ``key`` and ``value`` columns from a folder and writes
parquet outputs.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from tillstream.constants import (INPUT_TOPIC, WINDOW_ADVANCE_MINUTES, WINDOW_GRACE_MINUTES,
                                  WINDOW_SIZE_MINUTES)
from tillstream.session import RECOMMENDED_CONF, utc


def _pairs(texts) -> dict:
    return dict(t.split("=", 1) for t in texts)


def main(argv=None):
    p = argparse.ArgumentParser(prog="tillstream")
    sub = p.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("fanout", help="one invoice stream -> four outputs")
    src = f.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--messages", help="folder of JSON lines {key, value}")
    f.add_argument("--topic", default=INPUT_TOPIC)
    f.add_argument("--checkpoint", required=True, help="shared folder for checkpoints")
    f.add_argument("--out", help="output root for --messages mode")
    f.add_argument("--value-format", default="json", choices=["json", "avro"])
    f.add_argument("--avro-schema", help="Avro schema text for --value-format avro")
    f.add_argument("--key-format", default="string", choices=["string", "avro"],
                   help="record keys as text or registry-framed Avro MessageKey")
    f.add_argument("--event-time", default=None,
                   help="'timestamp' (record time, Kafka default) or 'createdTime'")
    f.add_argument("--trigger-seconds", type=float, default=1.0)
    f.add_argument("--max-offsets-per-trigger", type=int, default=None,
                   help="records of a micro-batch (Kafka mode; default 5 million)")
    f.add_argument("--available-now", action="store_true", help="process what exists, then stop")
    f.add_argument("--loyalty-mode", default="aggregate", choices=["aggregate", "stateful"],
                   help="keyed-aggregate changelog or one notification per invoice")
    f.add_argument("--drop-window-bounds", action="store_true",
                   help="store-sales records without window_start/window_end")
    f.add_argument("--partition-hadoop-by", nargs="*", default=(),
                   help="partition columns of the hadoop-sink files (--messages mode)")
    f.add_argument("--window-size-minutes", type=int, default=WINDOW_SIZE_MINUTES)
    f.add_argument("--window-advance-minutes", type=int, default=WINDOW_ADVANCE_MINUTES)
    f.add_argument("--grace-minutes", type=int, default=WINDOW_GRACE_MINUTES)
    f.add_argument("--query-prefix", default="invoice-fanout", help="names the streaming queries")
    f.add_argument("--output-format", default=None,
                   help="json or avro (Kafka mode), parquet, json or orc (message mode)")
    f.add_argument("--output-topic", nargs="*", default=(), metavar="OUTPUT=TOPIC")
    f.add_argument("--schema-id", nargs="*", default=(), metavar="OUTPUT=ID",
                   help="registry schema ids of Avro outputs")
    f.add_argument("--key-schema-id", type=int, help="registry schema id of Avro output keys")
    f.add_argument("--kafka-option", nargs="*", default=(), metavar="NAME=VALUE",
                   help="further client options, e.g. kafka.security.protocol=SSL")
    a = p.parse_args(argv)
    windows = {"window_size_minutes": a.window_size_minutes,
               "window_advance_minutes": a.window_advance_minutes,
               "grace_minutes": a.grace_minutes}

    b = SparkSession.builder.appName("tillstream-fanout")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()

    from tillstream.plans.fanout import (MAX_OFFSETS_PER_TRIGGER, FanoutPaths, file_writers,
                                         run_fanout, run_fanout_kafka)
    from tillstream.sources.adapters import invoices_from_messages
    with utc(spark):
        if a.kafka:
            qs = run_fanout_kafka(spark, a.kafka, a.checkpoint, a.topic, a.value_format,
                                  a.avro_schema, a.event_time or "timestamp", a.trigger_seconds,
                                  a.max_offsets_per_trigger or MAX_OFFSETS_PER_TRIGGER,
                                  a.key_format, not a.drop_window_bounds, a.loyalty_mode,
                                  a.output_format or "json", _pairs(a.output_topic),
                                  {k: int(v) for k, v in _pairs(a.schema_id).items()},
                                  a.key_schema_id, _pairs(a.kafka_option), a.query_prefix,
                                  **windows)
        else:
            # Avro keys come as Base64 text in JSON lines
            msgs = spark.readStream.schema("key string, value string").json(a.messages)
            if a.key_format == "avro":
                msgs = msgs.withColumn("key_bytes", F.unbase64("key"))
            inv = invoices_from_messages(msgs, a.value_format, a.avro_schema,
                                         a.event_time or "createdTime", a.key_format)
            writers = file_writers(FanoutPaths(a.out or a.checkpoint),
                                   {"hadoop-sink": tuple(a.partition_hadoop_by)},
                                   a.output_format or "parquet")
            qs = run_fanout(inv, a.checkpoint, available_now=a.available_now,
                            trigger_seconds=a.trigger_seconds, writers=writers,
                            store_window_bounds=not a.drop_window_bounds,
                            loyalty_mode=a.loyalty_mode, query_prefix=a.query_prefix,
                            **windows)
    if isinstance(qs, list):
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
