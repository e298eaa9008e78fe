"""A keyed, partitioned record log as a table: dense offsets and bounded replay.

Offsets count the records of a partition in order of arrival, from 0 without gaps. They
are prefix counts over buckets of the arrival (``operators.running``), so no task has to
number a whole partition. The table is stored sorted by (partition, offset): a bounded
read pushes both ranges to the scan, which skips the files and row groups outside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.operators.running import prefix


def with_offsets(records: DataFrame, order: list[str], bucket: Column,
                 partition: str = "partition") -> DataFrame:
    """Adds ``offset``. ``order`` must be total within a partition for offsets to be the same
    in every run; ``bucket`` follows it (see ``running.prefix``)."""
    out = prefix(records.withColumn("_one", F.lit(1).cast("bigint")), [partition], order,
                 {"_one": "sum"}, bucket)
    return out.withColumn("offset", F.col("run__one") - 1).drop("_one", "run__one")


def write_log(records: DataFrame, path: str, files: int | None = None,
              partition: str = "partition", mode: str = "error") -> None:
    """Store records sorted by (partition, offset) in ``files`` files of about equal size."""
    keys = [partition, "offset"]
    spread = (records.repartitionByRange(files, *keys) if files
              else records.repartitionByRange(*keys))
    spread.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def read_log(spark: SparkSession, path: str, partition: int, from_offset: int = 0,
             until_offset: int | None = None, partition_col: str = "partition") -> DataFrame:
    """The records of one partition from ``from_offset`` up to, but not including,
    ``until_offset`` (default: the end)."""
    own = (F.col(partition_col) == partition) & (F.col("offset") >= from_offset)
    if until_offset is not None:
        own = own & (F.col("offset") < until_offset)
    return spark.read.parquet(path).where(own)
