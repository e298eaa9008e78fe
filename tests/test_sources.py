import json

from pyspark.sql import functions as F

from tillstream.schemas import NOTIFICATION, POS_INVOICE
from tillstream.sources.codec import avro_schema_json, decode_json, encode_json
from tillstream.sources.dimensions import read_addresses, read_products
from tillstream.operators.enrichment import (assemble_invoices, attach_address, enrich_lines,
                                             recompute_item_totals, with_line_totals)


def test_json_round_trip_keeps_nested_invoice(invoices):
    cols = [f.name for f in POS_INVOICE.fields]
    enc = encode_json(invoices, cols)
    assert enc.columns == ["key", "value"]
    dec = decode_json(enc, POS_INVOICE)
    assert dec.select("key", *cols).exceptAll(invoices.select("key", *cols)).count() == 0


def test_avro_schema_text_is_nullable_unions():
    s = json.loads(avro_schema_json(NOTIFICATION, "Notification"))
    assert s["type"] == "record" and len(s["fields"]) == 5
    assert all(f["type"][0] == "null" for f in s["fields"])


def test_dimension_files(spark, tmp_path):
    p = tmp_path / "products.json"
    p.write_text(json.dumps([
        {"itemCode": 7, "itemDescription": "Chair", "itemPrice": "120", "itemQty": 0},
        {"itemCode": 8, "itemDescription": "Table", "itemPrice": "75.5", "itemQty": 0}], indent=2))
    a = tmp_path / "address.json"
    a.write_text(json.dumps([
        {"addressLine": "1 A St", "city": "X", "state": "Y", "pinCode": "1", "contactNumber": ""}]))
    prods = {r.itemCode: r.itemPrice for r in read_products(spark, str(p)).collect()}
    assert prods == {"7": 120.0, "8": 75.5}
    addr = read_addresses(spark, str(a)).collect()
    assert addr[0].contactNumber == ""


def test_dimension_in_several_array_files(spark, tmp_path):
    from tillstream.sources.dimensions import write_json_arrays
    rows = spark.range(95).selectExpr("id as itemCode", "concat('p', id) as itemDescription",
                                      "cast(id / 4 as string) as itemPrice", "0 as itemQty")
    path = str(tmp_path / "many")
    write_json_arrays(rows, path, rows_per_file=20)
    back = read_products(spark, path)
    assert {(r.itemCode, r.itemDescription, r.itemPrice) for r in back.collect()} == {
        (str(i), f"p{i}", i / 4) for i in range(95)} and back.count() == 95
    assert len(back.inputFiles()) >= 3
    write_json_arrays(rows.limit(0), str(tmp_path / "none"))
    assert read_products(spark, str(tmp_path / "none")).count() == 0


def test_enrich_totals_assemble(spark, tmp_path):
    products = spark.createDataFrame([("7", "Chair", 120.0), ("8", "Table", 75.5)],
                                     "itemCode string, itemDescription string, itemPrice double")
    lines = spark.createDataFrame([("A", "7", 2), ("A", "8", 1), ("B", "8", 2), ("B", "9", 1)],
                                  "invoiceNumber string, itemCode string, itemQty int")
    inv = assemble_invoices(with_line_totals(enrich_lines(lines, products))).collect()
    by = {r.invoiceNumber: r for r in inv}
    assert by["A"].totalAmount == 315.5 and by["A"].numberOfItems == 2
    assert by["B"].totalAmount == 151.0  # unknown product: null price, skipped in the sum
    assert abs(by["A"].cgst - 315.5 * 0.025) < 1e-12 and by["A"].taxableAmount == 315.5
    nested = recompute_item_totals(spark.createDataFrame(
        [([("7", "Chair", 120.0, 3, 0.0)],)],
        "invoiceLineItems array<struct<itemCode:string,itemDescription:string,itemPrice:double,"
        "itemQty:int,totalValue:double>>"))
    assert nested.first().invoiceLineItems[0].totalValue == 360.0


def test_attach_address_only_for_home_delivery(invoices, spark):
    addrs = spark.createDataFrame([("C1", "L", "City", "St", "1", "9"), ("C2", "M", "T", "U", "2", "8")],
                                  "customerCardNo string, addressLine string, city string, "
                                  "state string, pinCode string, contactNumber string")
    out = {r.invoiceNumber: r.deliveryAddress
           for r in attach_address(invoices, addrs).collect()}
    assert out["1"].city == "City" and out["2"].city == "City"
    assert out["3"] is None and out["6"] is None  # not home deliveries: unchanged
    assert out["5"] is None  # home delivery, card without an address row


def test_invoice_totals_match_assembly(spark):
    from tillstream.operators.enrichment import invoice_totals
    lines = spark.createDataFrame([("A", 120.0, 2), ("A", 75.5, 1), ("B", 0.1, 3)],
                                  "invoiceNumber string, itemPrice double, itemQty int")
    lines = with_line_totals(lines).withColumn("itemCode", F.lit("x")) \
        .withColumn("itemDescription", F.lit("y"))
    a = assemble_invoices(lines).drop("invoiceLineItems")
    b = invoice_totals(lines)
    assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    assert {r.invoiceNumber: r.totalAmount for r in b.collect()} == {"A": 315.5, "B": 0.3}


def test_messages_with_record_time_and_offsets(spark, invoices):
    from datetime import datetime
    from tillstream.sources.adapters import invoices_from_messages
    cols = [f.name for f in POS_INVOICE.fields]
    enc = encode_json(invoices, cols).withColumn(
        "timestamp", F.lit(datetime(2024, 5, 1, 12, 0)).cast("timestamp")) \
        .withColumn("offset", F.monotonically_increasing_id())
    inv = invoices_from_messages(enc, event_time="timestamp")
    rows = inv.select("event_time", "k", "key").collect()
    assert {r.event_time for r in rows} == {datetime(2024, 5, 1, 12, 0)}
    assert len({r.k for r in rows}) == 6 and all(r.key for r in rows)
    by_created = invoices_from_messages(encode_json(invoices, cols))
    assert by_created.where("event_time IS NULL").count() == 0
