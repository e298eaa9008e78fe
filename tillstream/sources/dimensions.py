"""Dimension files stored as JSON arrays: products and delivery addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.schemas import ADDRESS_FILE, PRODUCT_FILE


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """Store rows as JSON arrays, about ``rows_per_file`` in a file (a reader takes a whole
    array at once, so a large dimension has several files)."""
    n = max(1, -(-df.count() // rows_per_file))
    row = F.struct(*df.columns)
    arrays = df.groupBy(F.pmod(F.xxhash64(F.to_json(row)), F.lit(n)).alias("_file")).agg(
        F.to_json(F.collect_list(row)).alias("value"))
    arrays.repartition(n, "_file").select("value").write.option(
        "maxRecordsPerFile", 1).text(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """itemCode (string), itemDescription, itemPrice (double).

    Prices are JSON strings in the file: read as STRING, then cast (declaring
    DOUBLE directly would read them as null).
    """
    raw = spark.read.schema(PRODUCT_FILE).option("multiLine", True).json(path)
    return raw.select(F.col("itemCode").cast("string").alias("itemCode"), "itemDescription",
                      F.col("itemPrice").cast("double").alias("itemPrice"))


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    """The five address fields as strings; empty strings are kept as they are."""
    return spark.read.schema(ADDRESS_FILE).option("multiLine", True).json(path)
