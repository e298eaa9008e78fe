"""Kafka topics as invoice sources and sinks (needs the spark-sql-kafka package).

Not exercised in the tests here (no connector jar, no broker); the file
stream in ``tables.stream_table`` is the tested equivalent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.constants import INPUT_TOPIC


def kafka_stream(spark: SparkSession, servers: str, topic: str = INPUT_TOPIC,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None, **options) -> DataFrame:
    """Unbounded read: key, value (binary), topic, partition, offset, timestamp.

    ``min_partitions`` splits the offset ranges of large topic partitions over
    several tasks, so one hot partition is not read by a single task."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    for k, v in options.items():
        r = r.option(k, v)
    # raw key bytes are kept for Avro-encoded keys (see adapters.invoices_from_messages)
    return (r.load().withColumn("key_bytes", F.col("key"))
            .withColumn("key", F.col("key").cast("string")))


def kafka_partition_batch(spark: SparkSession, servers: str, topic: str, partition: int = 0,
                          from_offset: int = 0, until_offset: int | None = None,
                          min_partitions: int | None = None) -> DataFrame:
    """Bounded read of one topic partition from an offset, keys included.
    ``min_partitions`` splits the offset range over several tasks."""
    start = f'{{"{topic}":{{"{partition}":{from_offset}}}}}'
    end = (f'{{"{topic}":{{"{partition}":{until_offset}}}}}' if until_offset is not None
           else "latest")
    r = (spark.read.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("assign", f'{{"{topic}":[{partition}]}}')
         .option("startingOffsets", start)
         .option("endingOffsets", end))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    return (r.load()
            .withColumn("key_bytes", F.col("key"))
            .withColumn("key", F.col("key").cast("string")))


def kafka_batch_writer(servers: str, topic: str, key_col: str = "key",
                       value_cols: list[str] | None = None, value_format: str = "json",
                       schema_id: int | None = None, key_schema_id: int | None = None,
                       options: dict | None = None):
    """foreachBatch function producing a batch's rows to a topic (acks=all).

    Values are JSON, or registry-framed Avro (``value_format="avro"`` with the
    registry's ``schema_id``, and ``key_schema_id`` for framed keys)."""
    from tillstream.sources.codec import encode_avro, encode_json

    def write(batch: DataFrame, batch_id: int):
        if value_format == "avro":
            out = encode_avro(batch, value_cols, key_col, schema_id=schema_id,
                              key_schema_id=key_schema_id)
        else:
            out = encode_json(batch, value_cols, key_col)
        w = out.write.format("kafka")
        for k, v in sink_options(servers, topic, options).items():
            w = w.option(k, v)
        w.save()
    return write


def sink_options(servers: str, topic: str, options: dict | None = None) -> dict:
    """Producer options: acks=all unless ``options`` says otherwise."""
    return {"kafka.bootstrap.servers": servers, "kafka.acks": "all", "topic": topic,
            **(options or {})}
