"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.session import scratch_path
from tillstream.sources.tables import table_path

#: One word: a run of anything but space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage with a copy that every executor can read again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(col: str | Column) -> Column:
    """The text as UTF-8 bytes; null becomes empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit("")).cast("binary")


def crc_remainder(doc_id: str | Column, mod: int) -> Column:
    """crc32 of doc_id as text, modulo ``mod`` (a null doc_id counts as empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


def lower_ascii(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def count_within(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows (partial counts per task, one number back)."""
    return df.count() <= bound


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast when ``df`` has at most ``rows`` rows; else leave the join to be shuffled."""
    return F.broadcast(df) if count_within(df, rows) else df


def model_rows(rows, schema: T.StructType, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def dumps(x) -> str:
    return json.dumps(x, separators=(",", ":"), sort_keys=True)
