"""Access to the parquet tables of a scale-factor folder."""

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_schema(spark: SparkSession, sf_dir: str, name: str):
    return read_table(spark, sf_dir, name).schema


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table as an unbounded file stream (one file per table here).

    A file stream needs a folder and an explicit schema; the table's own
    schema is taken from its footer and the file is selected with a glob.
    """
    path = table_path(sf_dir, name)
    r = spark.readStream.schema(table_schema(spark, sf_dir, name))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    local = path[len("file:"):] if path.startswith("file:") else path
    if "://" not in path and os.path.isfile(local):
        return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return r.parquet(path)
