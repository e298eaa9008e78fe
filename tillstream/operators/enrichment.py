"""Invoice assembly from line items: product lookup, line totals, folding lines
into invoices with totals and taxes, and attaching delivery addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.constants import CESS_RATE, CGST_RATE, SGST_RATE
from tillstream.functions.money import money_sum
from tillstream.functions.predicates import is_home_delivery
from tillstream.schemas import LINE_ITEM

LINE_FIELDS = [f.name for f in LINE_ITEM.fields]


def enrich_lines(lines: DataFrame, products: DataFrame, code_col: str = "itemCode") -> DataFrame:
    """Product lookup per line: description and price come from the product table.

    ``products`` needs itemCode, itemDescription, itemPrice. Spark broadcasts it
    when its measured size is below the session's byte threshold; otherwise the
    join shuffles on the code (AQE splits a hot product's partition).
    """
    p = products.select(F.col("itemCode").alias("_pcode"),
                        F.col("itemDescription").alias("_pdesc"),
                        F.col("itemPrice").alias("_pprice"))
    j = lines.join(p, F.col(code_col) == F.col("_pcode"), "left")
    return (j.withColumn("itemDescription", F.col("_pdesc"))
             .withColumn("itemPrice", F.col("_pprice"))
             .drop("_pcode", "_pdesc", "_pprice"))


def line_total(price="itemPrice", qty="itemQty") -> F.Column:
    p = F.col(price) if isinstance(price, str) else price
    q = F.col(qty) if isinstance(qty, str) else qty
    return p * q


def with_line_totals(lines: DataFrame) -> DataFrame:
    """Flat lines: totalValue := itemPrice × itemQty."""
    return lines.withColumn("totalValue", line_total())


def recompute_item_totals(invoices: DataFrame) -> DataFrame:
    """Nested form: rewrite totalValue inside every element of invoiceLineItems."""
    return invoices.withColumn("invoiceLineItems", F.transform(
        "invoiceLineItems",
        lambda x: x.withField("totalValue", x.getField("itemPrice") * x.getField("itemQty"))))


def with_taxes(df: DataFrame, total_col: str = "totalAmount") -> DataFrame:
    t = F.col(total_col)
    return (df.withColumn("taxableAmount", t)
              .withColumn("cgst", t * F.lit(float(CGST_RATE)))
              .withColumn("sgst", t * F.lit(float(SGST_RATE)))
              .withColumn("cess", t * F.lit(float(CESS_RATE))))


def assemble_invoices(lines: DataFrame, invoice_col: str = "invoiceNumber") -> DataFrame:
    """Fold flat lines into invoices: sorted item array, item count, total of
    line values and taxes. One hash aggregate on the invoice id;
    an invoice's array holds only its own lines."""
    agg = (lines.groupBy(invoice_col)
           .agg(F.sort_array(F.collect_list(F.struct(*LINE_FIELDS))).alias("invoiceLineItems"),
                F.count(F.lit(1)).cast("int").alias("numberOfItems"),
                money_sum("totalValue").alias("totalAmount")))
    return with_taxes(agg)


def invoice_totals(lines: DataFrame, invoice_col: str = "invoiceNumber") -> DataFrame:
    """Scalar part of ``assemble_invoices`` (no array): count, total and taxes."""
    agg = (lines.groupBy(invoice_col)
           .agg(F.count(F.lit(1)).cast("int").alias("numberOfItems"),
                money_sum("totalValue").alias("totalAmount")))
    return with_taxes(agg)


def attach_address(invoices: DataFrame, addresses: DataFrame, on: str = "customerCardNo",
                   address_on: str | None = None) -> DataFrame:
    """Set deliveryAddress from ``addresses`` only for home deliveries; other
    invoices keep theirs. ``addresses`` has the key column and the five
    address fields; it is joined by key."""
    address_on = address_on or on
    a = addresses.select(F.col(address_on).alias("_akey"),
                         F.struct("addressLine", "city", "state", "pinCode", "contactNumber")
                         .alias("_addr"))
    j = invoices.join(a, F.col(on) == F.col("_akey"), "left")
    return (j.withColumn("deliveryAddress",
                         F.when(is_home_delivery("deliveryType"), F.col("_addr"))
                          .otherwise(F.col("deliveryAddress")))
             .drop("_akey", "_addr"))
