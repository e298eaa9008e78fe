"""Registered batch queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the whole driver tables. Column names match the SQL in
``tillstream.plans.oracle``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.constants import COMMIT_INTERVAL_MS, WINDOW_GRACE_MINUTES
from tillstream.operators import (enrichment, loyalty, metrics, stateless, store_sales,
                                  stream_time)
from tillstream.session import scratch_path, utc
from tillstream.sources import adapters, dimensions
from tillstream.sources.tables import read_table

FLAT_INVOICE = ["key", "invoiceNumber", "createdTime", "customerCardNo", "totalAmount",
                "numberOfItems", "paymentMethod", "taxableAmount", "cgst", "sgst", "cess",
                "storeID", "posID", "cashierID", "customerType", "deliveryType",
                "addressLine", "city", "state", "pinCode", "contactNumber"]


def in_utc(query):
    """Build the query with the session time zone set to UTC (fixed into the plan)."""
    @functools.wraps(query)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        with utc(spark):
            return query(spark, sf_dir)
    return build


def flat_invoice(df: DataFrame) -> DataFrame:
    return stateless.flatten_address(df).select(*FLAT_INVOICE)


def _headers(spark, sf_dir):
    return adapters.invoices(spark, sf_dir, lines=False)


def _amounts(spark, sf_dir):
    """Headers without line counts and addresses, for queries that read neither."""
    return adapters.invoices(spark, sf_dir, lines=False, items=False, address=False)


@in_utc
def invoice_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_invoice(_headers(spark, sf_dir))


@in_utc
def shipment_filter(spark, sf_dir):
    return flat_invoice(stateless.shipment_filter(_headers(spark, sf_dir)))


@in_utc
def prime_filter(spark, sf_dir):
    return flat_invoice(stateless.prime_filter(_headers(spark, sf_dir)))


@in_utc
def hadoop_flatten(spark, sf_dir):
    """Flattened line records from the tables: headers ⋈ lines (no arrays built)."""
    return stateless.hadoop_records_from_lines(
        _headers(spark, sf_dir), adapters.invoice_lines(spark, sf_dir), keep=("key",))


@in_utc
def hadoop_flatten_nested(spark, sf_dir):
    """The same records from nested invoices, as the service makes them."""
    return stateless.hadoop_records(adapters.invoices(spark, sf_dir), keep=("key",))


@in_utc
def mask_invoice(spark, sf_dir):
    return flat_invoice(stateless.mask_invoice(_headers(spark, sf_dir)))


@in_utc
def notification_projection(spark, sf_dir):
    return stateless.notification(stateless.prime_filter(_amounts(spark, sf_dir)),
                                  keep=("key",))


@in_utc
def rekey_by_store(spark, sf_dir):
    return store_sales.rekey_by_store(_amounts(spark, sf_dir)).select(
        "key", "invoiceNumber", "createdTime", "storeID", "totalAmount")


@in_utc
def intake_metrics(spark, sf_dir):
    return metrics.intake_summary(_amounts(spark, sf_dir))


@in_utc
def loyalty_latest(spark, sf_dir):
    return loyalty.loyalty_latest(_amounts(spark, sf_dir))


@in_utc
def loyalty_reduce(spark, sf_dir):
    """Invoice -> notification (prime only) -> keyed reduce, as composed upstream."""
    notes = stateless.notification(stateless.prime_filter(_amounts(spark, sf_dir)),
                                   keep=("event_time", "k"))
    return loyalty.loyalty_reduce(notes)


@in_utc
def loyalty_changelog(spark, sf_dir):
    return loyalty.loyalty_changelog(_amounts(spark, sf_dir))


@in_utc
def store_sales_hopping(spark, sf_dir):
    return store_sales.hopping_store_sales(adapters.store_events(spark, sf_dir))


@in_utc
def store_sales_hopping_direct(spark, sf_dir):
    """Same result through F.window (row expansion) instead of panes; for the bench."""
    return store_sales.hopping_store_sales(adapters.store_events(spark, sf_dir),
                                           method="window")


@in_utc
def store_sales_tumbling(spark, sf_dir):
    return store_sales.tumbling_store_sales(adapters.store_events(spark, sf_dir))


@in_utc
def store_sales_unwindowed(spark, sf_dir):
    return store_sales.unwindowed(
        store_sales.hopping_store_sales(adapters.store_events(spark, sf_dir)))


@in_utc
def store_sales_final_batch(spark, sf_dir):
    """Final-only windows on a table: those closed by its watermark (max event time
    minus the grace period), as a stream would emit them in append mode."""
    ev = adapters.store_events(spark, sf_dir)
    # one value, as epoch microseconds (no local-time conversion on the driver)
    newest = ev.agg(F.max(F.unix_micros("event_time")).alias("m")).first().m
    if newest is None:
        return store_sales.hopping_store_sales(ev).limit(0)
    grace_us = WINDOW_GRACE_MINUTES * 60 * 1_000_000
    watermark = F.timestamp_micros(F.lit(newest - grace_us)).cast("timestamp_ntz")
    return store_sales.closed_windows(store_sales.hopping_store_sales(ev), watermark)


def _arriving(spark, sf_dir, delayed: bool = True):
    """Events as records of a topic: partition, arrival and stream time.

    A store's records share one of four partitions. They arrive in the order of their id,
    or ``delayed`` by up to 90 minutes, so that many come late.
    """
    ev = adapters.store_events(spark, sf_dir)
    at = F.unix_micros("event_time") + F.pmod(F.col("k") * F.lit(7919), F.lit(5400)) * F.lit(1_000_000)
    store = F.substr("storeID", F.lit(4)).cast("bigint")
    ev = ev.select("*", (at if delayed else F.col("k")).alias("arrival"),
                   F.pmod(store, F.lit(4)).alias("partition"))
    return stream_time.with_stream_time(ev, 3_600_000_000 if delayed else 1_000_000)


@in_utc
def store_sales_grace_exact(spark, sf_dir):
    """Grace by the stream time of each record; events arrive in the order of their id."""
    return stream_time.graced_store_sales(_arriving(spark, sf_dir, delayed=False))


@in_utc
def store_sales_grace_delayed(spark, sf_dir):
    """The same with arrivals delayed by up to 90 minutes: late records miss windows."""
    return stream_time.graced_store_sales(_arriving(spark, sf_dir))


@in_utc
def store_sales_changelog(spark, sf_dir):
    """All emissions at the commit interval, of the delayed arrivals."""
    tick = F.floor(F.col("arrival") / F.lit(COMMIT_INTERVAL_MS * 1000))
    return stream_time.store_sales_changelog(_arriving(spark, sf_dir), tick)


@in_utc
def store_sales_suppressed(spark, sf_dir):
    """Each closed window once, with the record that released it, of the delayed arrivals."""
    return stream_time.suppressed_store_sales(_arriving(spark, sf_dir)).drop("released_at")


@in_utc
def line_enrichment(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("itemCode"),
        F.col("l_quantity").cast("int").alias("itemQty"))
    return enrichment.enrich_lines(li, adapters.products(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "itemCode", "itemDescription", "itemPrice", "itemQty")


@in_utc
def product_dimension(spark, sf_dir):
    """Products as JSON arrays with prices as text, read back as the lookup dimension."""
    parts = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("itemCode"), F.col("p_name").alias("itemDescription"),
        F.col("p_retailprice").cast("string").alias("itemPrice"), F.lit(0).alias("itemQty"))
    path = scratch_path(spark, "products")
    dimensions.write_json_arrays(parts, path)
    return dimensions.read_products(spark, path)


@in_utc
def address_dimension(spark, sf_dir):
    """Delivery addresses as JSON arrays, read back; every third has an empty contact number,
    which stays empty."""
    contact = F.when(F.col("contactNumber").cast("bigint") % 3 == 0, "").otherwise(
        F.col("contactNumber"))
    rows = adapters.customer_addresses(spark, sf_dir).select(
        "addressLine", "city", "state", "pinCode", contact.alias("contactNumber"))
    path = scratch_path(spark, "addresses")
    dimensions.write_json_arrays(rows, path)
    return dimensions.read_addresses(spark, path)


def _order_numbers(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("invoiceNumber"))


@in_utc
def line_totals(spark, sf_dir):
    """Line totals (price × qty) of every invoice's lines, on flat line rows."""
    lines = enrichment.with_line_totals(adapters.invoice_lines(spark, sf_dir))
    j = lines.join(_order_numbers(spark, sf_dir), F.col("l_orderkey") == F.col("k"))
    return j.select("invoiceNumber", "itemCode", "itemPrice", "itemQty", "totalValue")


@in_utc
def line_totals_nested(spark, sf_dir):
    """The same inside each invoice's array, then one row per element."""
    inv = enrichment.recompute_item_totals(adapters.invoices(spark, sf_dir, address=False))
    return inv.select("invoiceNumber", F.explode("invoiceLineItems").alias("li")).select(
        "invoiceNumber", "li.itemCode", "li.itemPrice", "li.itemQty", "li.totalValue")


def _with_header(inv, spark, sf_dir):
    head = _amounts(spark, sf_dir).select("k", "invoiceNumber", "customerCardNo", "storeID",
                                          "deliveryType")
    return inv.join(head, F.col("l_orderkey") == F.col("k"))


@in_utc
def invoice_assembly(spark, sf_dir):
    """Lines folded into invoices; the sorted item array as JSON text."""
    # fold on the numeric order key (cheaper to hash than the text number)
    lines = enrichment.with_line_totals(adapters.invoice_lines(spark, sf_dir))
    inv = enrichment.assemble_invoices(lines, invoice_col="l_orderkey")
    return _with_header(inv, spark, sf_dir).select(
        "invoiceNumber", "customerCardNo", "storeID", "deliveryType", "numberOfItems",
        F.to_json("invoiceLineItems").alias("items"),
        "totalAmount", "taxableAmount", "cgst", "sgst", "cess")


@in_utc
def invoice_totals(spark, sf_dir):
    """The scalar part: item count, total and taxes, without building arrays."""
    lines = enrichment.with_line_totals(adapters.invoice_lines(spark, sf_dir))
    inv = enrichment.invoice_totals(lines, invoice_col="l_orderkey")
    return _with_header(inv, spark, sf_dir).select(
        "invoiceNumber", "customerCardNo", "storeID", "deliveryType", "numberOfItems",
        "totalAmount", "taxableAmount", "cgst", "sgst", "cess")


@in_utc
def address_enrichment(spark, sf_dir):
    raw = adapters.invoices(spark, sf_dir, lines=False, address=False)
    addr = adapters.customer_addresses(spark, sf_dir)
    return flat_invoice(enrichment.attach_address(raw, addr, on="customerCardNo"))


BATCH_QUERIES = {
    "invoice_source": invoice_source,
    "shipment_filter": shipment_filter,
    "prime_filter": prime_filter,
    "hadoop_flatten": hadoop_flatten,
    "hadoop_flatten_nested": hadoop_flatten_nested,
    "mask_invoice": mask_invoice,
    "notification_projection": notification_projection,
    "rekey_by_store": rekey_by_store,
    "intake_metrics": intake_metrics,
    "loyalty_latest": loyalty_latest,
    "loyalty_reduce": loyalty_reduce,
    "loyalty_changelog": loyalty_changelog,
    "store_sales_hopping": store_sales_hopping,
    "store_sales_tumbling": store_sales_tumbling,
    "store_sales_unwindowed": store_sales_unwindowed,
    "store_sales_final_batch": store_sales_final_batch,
    "store_sales_grace_exact": store_sales_grace_exact,
    "store_sales_grace_delayed": store_sales_grace_delayed,
    "store_sales_changelog": store_sales_changelog,
    "store_sales_suppressed": store_sales_suppressed,
    "line_enrichment": line_enrichment,
    "product_dimension": product_dimension,
    "address_dimension": address_dimension,
    "line_totals": line_totals,
    "line_totals_nested": line_totals_nested,
    "invoice_assembly": invoice_assembly,
    "invoice_totals": invoice_totals,
    "address_enrichment": address_enrichment,
}
