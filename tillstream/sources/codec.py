"""Message value codecs: JSON (built in) and Avro (``avro_columns``, Arrow batches).

Values travel as a ``value`` column next to a ``key`` column, the shape of
Kafka records. Schemas come from ``tillstream.schemas``; nothing is inferred.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tillstream.schemas import MESSAGE_KEY
from tillstream.sources import avro_columns

# A schema-registry framed Avro value starts with 1 magic byte and a 4-byte id.
REGISTRY_HEADER_BYTES = avro_columns.HEADER


def encode_json(df: DataFrame, value_cols: list[str] | None = None,
                key_col: str | None = "key") -> DataFrame:
    """Rows -> (key, value) with value = JSON of the chosen columns."""
    cols = value_cols or [c for c in df.columns if c != key_col]
    out = [F.to_json(F.struct(*cols)).alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*out)


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
                keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """(key, value JSON) -> key plus the record's columns. Malformed values give nulls."""
    v = F.col(value_col)
    if isinstance(df.schema[value_col].dataType, T.BinaryType):
        v = v.cast("string")
    keep = tuple(c for c in keep if c in df.columns)
    return df.select(*keep, F.from_json(v, schema).alias("_r")).select(*keep, "_r.*")


def avro_schema_json(schema: T.StructType, name: str, namespace: str = "tillstream") -> str:
    """Avro schema text for a flat/nested StructType; every field a nullable union."""
    def conv(dt, nm):
        if isinstance(dt, T.StringType):
            return "string"
        if isinstance(dt, T.LongType):
            return "long"
        if isinstance(dt, T.IntegerType):
            return "int"
        if isinstance(dt, T.DoubleType):
            return "double"
        if isinstance(dt, T.ArrayType):
            return {"type": "array", "items": conv(dt.elementType, nm + "Item")}
        if isinstance(dt, T.StructType):
            return {"type": "record", "name": nm, "fields": [
                {"name": f.name, "type": ["null", conv(f.dataType, f.name[0].upper() + f.name[1:])],
                 "default": None} for f in dt.fields]}
        raise TypeError(f"no Avro mapping for {dt}")
    rec = conv(schema, name)
    rec["namespace"] = namespace
    return json.dumps(rec)


def spark_type(kind: avro_columns.Kind) -> T.DataType:
    """The column type of an Avro type."""
    if kind.name == "record":
        return T.StructType([T.StructField(n, spark_type(k)) for n, k in kind.fields])
    if kind.name == "array":
        return T.ArrayType(spark_type(kind.items))
    return {"string": T.StringType(), "bytes": T.BinaryType(), "int": T.IntegerType(),
            "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
            "boolean": T.BooleanType(), "null": T.NullType()}[kind.name]


def _all_nullable(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _all_nullable(f.dataType)) for f in dt.fields])
    return T.ArrayType(_all_nullable(dt.elementType)) if isinstance(dt, T.ArrayType) else dt


def from_avro_records(value: Column, writers: str | dict[int, str],
                      reader: T.StructType | None = None) -> Column:
    """Binary column -> struct. ``writers`` is one schema text for plain Avro bodies, or
    schema texts by id for registry-framed values. ``reader`` is the struct to produce, by
    field name (default: the fields of the schema, or of the one with the highest id). A
    malformed value gives null; a schema id that is not listed ends the job."""
    kinds = ({i: avro_columns.parse(s) for i, s in writers.items()}
             if isinstance(writers, dict) else avro_columns.parse(writers))
    latest = kinds[max(kinds)] if isinstance(kinds, dict) else kinds
    reader = _all_nullable(reader or spark_type(latest))
    want = to_arrow_type(reader)

    @F.arrow_udf(reader)
    def read(v: pa.Array) -> pa.Array:
        return avro_columns.read_records(v, kinds, want)
    return read(value)


def registry_frame(payload: Column, schema_id: int) -> Column:
    """Binary payload -> magic byte 0, the schema id in four bytes (big-endian), payload."""
    if not 0 <= schema_id < 1 << 32:
        raise ValueError("a schema id has four bytes")
    header = F.unhex(F.lit(f"00{schema_id:08X}"))
    return F.concat(header, payload)


def to_avro_records(record: Column, schema_json: str, schema_id: int | None = None) -> Column:
    """Struct column -> Avro bodies, registry-framed if a schema id is given."""
    if schema_id is not None and not 0 <= schema_id < 1 << 32:
        raise ValueError("a schema id has four bytes")
    kind = avro_columns.parse(schema_json)

    @F.arrow_udf(T.BinaryType())
    def write(v: pa.Array) -> pa.Array:
        return avro_columns.write_records(v, kind, schema_id)
    return write(record)


def decode_avro(df: DataFrame, schema_json: str | dict[int, str], value_col: str = "value",
                registry_framed: bool = True, keep: tuple[str, ...] = ("key",),
                reader: T.StructType | None = None) -> DataFrame:
    """Avro value -> columns.

    With a dict, every record is read by the writer schema of its frame's id; with one
    schema text, by that schema (``registry_framed`` skips the header). Either way the
    columns are those of ``reader``, resolved by field name.
    """
    v = F.col(value_col)
    if registry_framed and not isinstance(schema_json, dict):
        v = F.expr(f"substring({value_col}, {REGISTRY_HEADER_BYTES + 1})")
    keep = tuple(c for c in keep if c in df.columns)
    return df.select(*keep, from_avro_records(v, schema_json, reader).alias("_r")).select(
        *keep, "_r.*")


def encode_avro(df: DataFrame, value_cols: list[str] | None = None,
                key_col: str | None = "key", schema_json: str | None = None,
                schema_id: int | None = None, key_schema_id: int | None = None) -> DataFrame:
    """Rows -> (key, Avro value).

    With ``schema_id`` the value gets the registry header; with ``key_schema_id`` the key
    is a framed Avro ``MessageKey`` record, else text. Without ``schema_json`` the schema
    is that of the columns, every field a nullable union (``avro_schema_json``)."""
    cols = value_cols or [c for c in df.columns if c != key_col]
    schema_json = schema_json or avro_schema_json(df.select(*cols).schema, "Record")
    out = [to_avro_records(F.struct(*cols), schema_json, schema_id).alias("value")]
    if key_col:
        key = F.col(key_col).cast("string")
        if key_schema_id is not None:
            key = to_avro_records(F.struct(key.alias("key")),
                                  avro_schema_json(MESSAGE_KEY, "MessageKey"), key_schema_id)
        out.insert(0, key.alias("key"))
    return df.select(*out)


def decode_avro_key(df: DataFrame, key_col: str = "key_bytes",
                    registry_framed: bool = True) -> DataFrame:
    """Avro ``MessageKey`` record (one nullable string field ``key``) -> ``key`` STRING."""
    k = F.col(key_col)
    if registry_framed:
        k = F.expr(f"substring({key_col}, {REGISTRY_HEADER_BYTES + 1})")
    schema = avro_schema_json(MESSAGE_KEY, "MessageKey")
    return df.withColumn("key", from_avro_records(k, schema).getField("key"))
