"""Avro columns: bytes from the format's specification, a record-by-record codec, bad values."""

import json
import struct

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import MESSAGE_KEY, NOTIFICATION, POS_INVOICE
from tillstream.sources import avro_columns as A
from tillstream.sources.codec import (avro_schema_json, decode_avro, decode_avro_key, encode_avro,
                                      from_avro_records, to_avro_records)


def varint(v):
    z, out = (v << 1) ^ (v >> 63), b""
    while z > 0x7F:
        out, z = out + bytes([z & 0x7F | 0x80]), z >> 7
    return out + bytes([z])


def write(s, v):
    """One value by the specification."""
    if isinstance(s, list):
        k = s.index("null") if v is None else 1 - s.index("null")
        return varint(k) + (b"" if v is None else write(s[k], v))
    kind = s if isinstance(s, str) else s["type"]
    if kind == "record":
        return b"".join(write(f["type"], v.get(f["name"])) for f in s["fields"])
    if kind == "array":
        return (varint(len(v)) + b"".join(write(s["items"], x) for x in v) if v else b"") + b"\0"
    if kind in ("string", "bytes"):
        raw = v.encode() if kind == "string" else v
        return varint(len(raw)) + raw
    if kind == "boolean":
        return bytes([v])
    return struct.pack("<f" if kind == "float" else "<d", v) if kind in ("float", "double") else (
        varint(v) if kind != "null" else b"")


ITEM = {"type": "record", "name": "Item", "fields": [
    {"name": "code", "type": ["null", "string"]}, {"name": "qty", "type": "int"}]}
SCHEMA = {"type": "record", "name": "R", "fields": [
    {"name": "a", "type": "long"}, {"name": "b", "type": ["string", "null"]},
    {"name": "d", "type": ["null", "double"]}, {"name": "ok", "type": "boolean"},
    {"name": "one", "type": ["null", ITEM]}, {"name": "many", "type": {"type": "array", "items": "Item"}},
    {"name": "deep", "type": ["null", {"type": "array", "items": ["null", {"type": "array", "items": "int"}]}]},
    {"name": "raw", "type": "bytes"}, {"name": "f", "type": "float"}]}
ITEM_T = pa.struct([("code", pa.string()), ("qty", pa.int32())])
WANT = pa.struct([("a", pa.int64()), ("b", pa.string()), ("d", pa.float64()), ("ok", pa.bool_()),
                  ("one", ITEM_T), ("many", pa.list_(ITEM_T)),
                  ("deep", pa.list_(pa.list_(pa.int32()))), ("raw", pa.binary()), ("f", pa.float32())])
item = st.fixed_dictionaries({"code": st.none() | st.text(max_size=9),
                              "qty": st.integers(-2**31, 2**31 - 1)})
value = st.fixed_dictionaries({
    "a": st.integers(-2**63, 2**63 - 1), "b": st.none() | st.text(max_size=80),
    "d": st.none() | st.floats(allow_nan=False), "ok": st.booleans(), "one": st.none() | item,
    "many": st.lists(item, max_size=4),
    "deep": st.none() | st.lists(st.none() | st.lists(st.integers(-99, 99), max_size=3), max_size=3),
    "raw": st.binary(max_size=5), "f": st.floats(width=32, allow_nan=False)})
# named types are written out for the plain codec
PLAIN = json.loads(json.dumps(SCHEMA).replace('"items": "Item"', '"items": ' + json.dumps(ITEM)))


def test_examples_of_the_specification():
    long_ = A.parse("\"long\"")
    for v, raw in ((0, "00"), (-1, "01"), (1, "02"), (-64, "7f"), (64, "8001"), (8192, "808001"),
                   (2**63 - 1, "feffffffffffffffff01"), (-2**63, "ffffffffffffffffff01")):
        assert A.write_records(pa.array([v]), long_).to_pylist() == [bytes.fromhex(raw)]
    record = A.parse({"type": "record", "name": "test", "fields": [
        {"name": "a", "type": "long"}, {"name": "b", "type": "string"}]})
    assert A.write_records(pa.array([{"a": 27, "b": "foo"}]), record).to_pylist() == [
        bytes.fromhex("3606666f6f")]
    array = A.parse({"type": "array", "items": "long"})
    assert A.write_records(pa.array([[3, 27]]), array).to_pylist() == [bytes.fromhex("04063600")]


@settings(max_examples=80, deadline=None)
@given(st.lists(value, max_size=6))
def test_equals_the_record_codec(rows):
    kind = A.parse(json.dumps(SCHEMA))
    raw = [write(PLAIN, r) for r in rows]
    assert A.write_records(pa.array(rows, WANT), kind).to_pylist() == raw
    assert A.read_records(pa.array(raw, pa.binary()), kind, WANT).to_pylist() == rows
    # a slice, other fields only, and a field that the writer lacks
    some = pa.struct([("new", pa.int64()), ("f", pa.float64()), ("many", pa.list_(
        pa.struct([("qty", pa.int64())])))])
    got = A.read_records(pa.array([b"x", *raw], pa.binary()).slice(1), kind, some).to_pylist()
    assert got == [{"new": None, "f": r["f"], "many": [{"qty": i["qty"]} for i in r["many"]]}
                   for r in rows]


def test_blocks_with_sizes_and_several_blocks():
    kind = A.parse({"type": "array", "items": "long"})
    raw = varint(-2) + varint(2) + b"\x02\x04" + varint(1) + b"\x06" + b"\0"
    assert A.read_records(pa.array([raw, b"\0", raw]), kind, pa.list_(pa.int64())).to_pylist() == [
        [1, 2, 3], [], [1, 2, 3]]


@settings(max_examples=60, deadline=None)
@given(value, st.integers(0, 60), st.binary(max_size=30))
def test_bad_values_are_null_and_hurt_no_other(row, cut, noise):
    kind, good = A.parse(json.dumps(SCHEMA)), write(PLAIN, row)
    cut = good[:min(cut, len(good) - 1)]
    got = A.read_records(pa.array([good, cut, None, noise, good], pa.binary()), kind, WANT).to_pylist()
    assert got[0] == got[4] == row and got[1] is None and got[2] is None


def test_frames_and_writer_schemas():
    old = {"type": "record", "name": "R", "fields": [{"name": "x", "type": "int"}]}
    new = {"type": "record", "name": "R", "fields": [
        {"name": "y", "type": ["null", "string"]}, {"name": "x", "type": "long"}]}
    kinds = {3: A.parse(old), 2**31: A.parse(new)}
    rows = [b"\0" + (3).to_bytes(4, "big") + write(old, {"x": 5}),
            b"\0" + (2**31).to_bytes(4, "big") + write(new, {"y": "é", "x": 6}),
            b"\1" + (3).to_bytes(4, "big") + b"\x02", b"\0\0", None]
    want = pa.struct([("x", pa.int64()), ("y", pa.string())])
    assert A.read_records(pa.array(rows), kinds, want).to_pylist() == [
        {"x": 5, "y": None}, {"x": 6, "y": "é"}, None, None, None]
    with pytest.raises(ValueError, match="no writer schema for id"):
        A.read_records(pa.array(rows), {3: kinds[3]}, want)
    assert A.read_records(pa.array([], pa.binary()), kinds, want).to_pylist() == []
    assert A.write_records(pa.array([{"x": 5}]), kinds[3], 3).to_pylist() == rows[:1]


def test_unsupported_and_null():
    for bad in ('["int", "string"]', '{"type": "map", "values": "int"}', '"Unknown"'):
        with pytest.raises(ValueError):
            A.parse(bad)
    with pytest.raises(ValueError):
        A.write_records(pa.array([1, None]), A.parse('"int"'))


def test_invoices_round_trip_on_spark(invoices):
    cols = [f.name for f in POS_INVOICE.fields]
    schema = avro_schema_json(POS_INVOICE, "PosInvoice")
    enc = encode_avro(invoices, cols, schema_json=schema, schema_id=7, key_schema_id=9)
    assert dict(enc.dtypes) == {"key": "binary", "value": "binary"}
    assert {bytes(r.value[:5]) for r in enc.collect()} == {b"\0\0\0\0\7"}
    back = decode_avro_key(enc.withColumnRenamed("key", "key_bytes"))
    for how in ({7: schema}, schema):
        dec = decode_avro(back, how, reader=POS_INVOICE)
        assert dec.select("key", *cols).exceptAll(invoices.select("key", *cols)).count() == 0
        assert dec.count() == 6


def test_messages_with_avro_values_and_keys(invoices):
    from tillstream.sources.adapters import invoices_from_messages
    cols = [f.name for f in POS_INVOICE.fields]
    schema = avro_schema_json(POS_INVOICE, "PosInvoice")
    enc = encode_avro(invoices, cols, schema_json=schema, schema_id=7, key_schema_id=9)
    got = invoices_from_messages(enc.withColumnRenamed("key", "key_bytes"), "avro", {7: schema},
                                 key_format="avro")
    assert got.select("key", *cols).exceptAll(invoices.select("key", *cols)).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | st.text(max_size=5), st.none() | st.floats(allow_nan=False)),
                min_size=1, max_size=20))
def test_columns_on_spark(spark, rows):
    df = spark.createDataFrame(rows, "customerCardNo string, totalAmount double")
    schema = avro_schema_json(NOTIFICATION, "Notification")
    raw = df.select(to_avro_records(F.struct(*df.columns), schema).alias("v"))
    out = raw.select(from_avro_records(F.col("v"), schema).alias("r")).select("r.*")
    assert out.schema.simpleString() == NOTIFICATION.simpleString()
    assert sorted(map(repr, out.select(*df.columns).collect())) == sorted(map(repr, df.collect()))
    assert MESSAGE_KEY["key"].dataType == T.StringType()
