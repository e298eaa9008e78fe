"""Turn the driver's order tables into invoices (and events into store sales).

orders ⋈ customer ⋈ nation ⋈ region give the invoice header; lineitem ⋈ part
give its lines. Works on batch tables and on a streaming ``orders`` (the
dimension joins are then stream-static joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.constants import CESS_RATE, CGST_RATE, HOME_DELIVERY, PRIME, SGST_RATE
from tillstream.functions.predicates import is_home_delivery
from tillstream.functions.time import event_time_from_millis, millis_of
from tillstream.operators.enrichment import enrich_lines
from tillstream.operators.stateless import key_by
from tillstream.schemas import DELIVERY_ADDRESS, LINE_ITEM
from tillstream.sources.tables import read_table, stream_table

# Fixed mapping of the test tables onto invoice vocabularies.
PAYMENT_BY_MOD3 = ("CASH", "CARD", "WALLET")
PRIME_SEGMENTS = ("BUILDING", "AUTOMOBILE")
DELIVERY_BY_STATUS = {"F": HOME_DELIVERY, "O": "Home-Delivery", "P": "TAKEAWAY"}
NON_PRIME = "NONPRIME"
STORE_COUNT_EVENTS = 10


def _customers(spark: SparkSession, sf_dir: str, places: bool = True) -> DataFrame:
    """customer, and with ``places`` the names of its nation and region."""
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    if not places:
        return cust
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as the product dimension: itemCode, itemDescription, itemPrice."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("itemCode"),
        F.col("p_name").alias("itemDescription"),
        F.col("p_retailprice").alias("itemPrice"))


def invoice_lines(spark: SparkSession, sf_dir: str,
                  lineitem: DataFrame | None = None) -> DataFrame:
    """One row per line: l_orderkey plus the LineItem fields (lineitem + product lookup).
    ``lineitem`` replaces the table (e.g. by a part of it)."""
    li = (read_table(spark, sf_dir, "lineitem") if lineitem is None else lineitem).select(
        "l_orderkey", "l_linenumber",
        F.col("l_partkey").cast("string").alias("itemCode"),
        F.col("l_quantity").cast("int").alias("itemQty"),
        F.col("l_extendedprice").alias("totalValue"))
    return enrich_lines(li, products(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", *[f.name for f in LINE_ITEM.fields])


def _nested_lines(spark: SparkSession, sf_dir: str,
                  lineitem: DataFrame | None = None) -> DataFrame:
    """Lines folded per order into the invoice's array (sorted, so deterministic).

    The array is per invoice (a handful of lines each), not a group of the
    data set; the fold is a hash aggregate on l_orderkey.
    """
    fields = [f.name for f in LINE_ITEM.fields]
    return (invoice_lines(spark, sf_dir, lineitem)
            .groupBy("l_orderkey")
            .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("invoiceLineItems")))


def _line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("_n_lines")))


def invoice_headers(orders: DataFrame, customers: DataFrame, address: bool = True) -> DataFrame:
    """Header columns of the invoice plus ``k`` (order key) and ``event_time``;
    without ``address`` the delivery address is null."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    j = o.join(customers, o.o_custkey == customers.c_custkey, "left")
    status = F.col("o_orderstatus")
    delivery = F.when(status == "F", DELIVERY_BY_STATUS["F"]) \
        .when(status == "O", DELIVERY_BY_STATUS["O"]) \
        .when(status == "P", DELIVERY_BY_STATUS["P"])
    pay = F.col("o_orderkey") % 3
    total = F.col("o_totalprice")
    return j.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_orderkey").cast("string").alias("invoiceNumber"),
        millis_of("o_orderdate").alias("createdTime"),
        F.col("o_custkey").cast("string").alias("customerCardNo"),
        total.alias("totalAmount"),
        F.when(pay == 0, PAYMENT_BY_MOD3[0]).when(pay == 1, PAYMENT_BY_MOD3[1])
         .otherwise(PAYMENT_BY_MOD3[2]).alias("paymentMethod"),
        total.alias("taxableAmount"),
        (total * F.lit(float(CGST_RATE))).alias("cgst"),
        (total * F.lit(float(SGST_RATE))).alias("sgst"),
        (total * F.lit(float(CESS_RATE))).alias("cess"),
        F.concat(F.lit("STR"), F.col("c_nationkey").cast("string")).alias("storeID"),
        F.concat(F.lit("POS"), (F.col("o_orderkey") % 10).cast("string")).alias("posID"),
        F.concat(F.lit("OAS"), (F.col("o_orderkey") % 7).cast("string")).alias("cashierID"),
        F.when(F.col("c_mktsegment").isin(*PRIME_SEGMENTS), PRIME)
         .otherwise(NON_PRIME).alias("customerType"),
        delivery.alias("deliveryType"),
        (F.when(is_home_delivery(delivery), F.struct(
            F.col("c_name").alias("addressLine"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad(F.col("c_nationkey").cast("string"), 6, "0").alias("pinCode"),
            F.col("c_custkey").cast("string").alias("contactNumber"),
        )) if address else F.lit(None).cast(DELIVERY_ADDRESS)).alias("deliveryAddress"),
    )


def invoices(spark: SparkSession, sf_dir: str, lines: bool = True,
             stream: bool = False, items: bool = True, address: bool = True,
             orders: DataFrame | None = None, lineitem: DataFrame | None = None) -> DataFrame:
    """Invoice DataFrame (PosInvoice columns + ``key``, ``k``, ``event_time``).

    ``lines=False`` skips building the line array (only ``numberOfItems`` is
    computed), which is all the header-only operators need. ``stream=True``
    reads ``orders`` as a file stream; ``items=False`` (header-only) leaves
    numberOfItems null instead of joining line counts; ``address=False``
    leaves deliveryAddress null instead of joining nation and region.
    ``orders`` replaces the table (e.g. by a stream of parts of it), ``lineitem``
    the table of the lines in the array (e.g. by those of the orders in a part).

    Streaming reads join the static tables (customers, line arrays) in every
    micro-batch, which suits the bounded test runs this adapter serves; a live
    service receives whole invoices as messages (``invoices_from_messages``).
    """
    if orders is None:
        orders = (stream_table(spark, sf_dir, "orders") if stream
                  else read_table(spark, sf_dir, "orders"))
    h = invoice_headers(orders, _customers(spark, sf_dir, places=address), address)
    if lines:
        nl = _nested_lines(spark, sf_dir, lineitem)
        h = h.join(nl, h.k == nl.l_orderkey, "left").withColumn(
            "invoiceLineItems", F.coalesce("invoiceLineItems", F.array().cast(
                "array<struct<itemCode:string,itemDescription:string,itemPrice:double,"
                "itemQty:int,totalValue:double>>")))
        h = h.withColumn("numberOfItems", F.size("invoiceLineItems"))
    elif not items:
        h = h.withColumn("numberOfItems", F.lit(None).cast("int"))
    else:
        lc = _line_counts(spark, sf_dir)
        h = h.join(lc, h.k == lc.l_orderkey, "left").withColumn(
            "numberOfItems", F.coalesce("_n_lines", F.lit(0)))
    cols = ["invoiceNumber", "createdTime", "customerCardNo", "totalAmount", "numberOfItems",
            "paymentMethod", "taxableAmount", "cgst", "sgst", "cess", "storeID", "posID",
            "cashierID", "customerType", "deliveryType", "deliveryAddress"]
    if lines:
        cols.append("invoiceLineItems")
    # The message key is the customer card (what the publisher keys by).
    return key_by(h, "customerCardNo").select("key", *cols, "k", "event_time")


def store_events(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """events as store-sale records: storeID, totalAmount, event_time, k.
    ``events`` replaces the table (e.g. by a stream of parts of it)."""
    ev = read_table(spark, sf_dir, "events") if events is None else events
    return ev.select(
        F.concat(F.lit("STR"), (F.col("user_id") % STORE_COUNT_EVENTS).cast("string")).alias("storeID"),
        F.col("value").alias("totalAmount"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("k"),
    )


def customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address dimension keyed by card: one row per customer."""
    c = _customers(spark, sf_dir)
    return c.select(
        F.col("c_custkey").cast("string").alias("customerCardNo"),
        F.col("c_name").alias("addressLine"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(F.col("c_nationkey").cast("string"), 6, "0").alias("pinCode"),
        F.col("c_custkey").cast("string").alias("contactNumber"),
    )


def invoices_from_messages(messages: DataFrame, value_format: str = "json",
                           avro_schema: str | dict[int, str] | None = None,
                           event_time: str = "createdTime",
                           key_format: str = "string") -> DataFrame:
    """Kafka-shaped (key, value[, timestamp, partition, offset]) rows -> invoice rows.

    ``avro_schema`` is the writer schema, or schemas by the registry id of the
    frame. ``key_format="avro"`` decodes registry-framed Avro keys from ``key_bytes``
    (as ``kafka_stream`` provides); ``event_time="createdTime"`` uses the
    invoice's own epoch-millis field;
    ``"timestamp"`` uses the record (broker) time. The tie key ``k`` is the
    record's (partition, offset) when present, else the invoice number's hash.
    """
    from tillstream.schemas import POS_INVOICE
    from tillstream.sources.codec import decode_avro, decode_avro_key, decode_json
    if key_format == "avro":  # registry-framed Avro MessageKey records
        messages = decode_avro_key(messages)
    keep = tuple(c for c in ("key", "timestamp", "partition", "offset") if c in messages.columns)
    if value_format == "json":
        inv = decode_json(messages, POS_INVOICE, keep=keep)
    elif value_format == "avro":
        inv = decode_avro(messages, avro_schema, keep=keep, reader=POS_INVOICE)
    else:
        raise ValueError(f"unknown value format {value_format}")
    if event_time == "timestamp":
        ts = F.col("timestamp").cast("timestamp")
    else:
        ts = event_time_from_millis(event_time)
    arrived = {"partition", "offset"} <= set(keep)
    tie = F.struct("partition", "offset") if arrived else F.xxhash64("invoiceNumber")
    inv = inv.withColumn("event_time", ts).withColumn("k", tie)
    if "key" not in inv.columns:
        inv = key_by(inv, "customerCardNo")
    return inv.withColumn("invoiceLineItems", F.coalesce(
        "invoiceLineItems", F.array().cast(POS_INVOICE["invoiceLineItems"].dataType)))
