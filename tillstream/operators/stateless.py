"""Per-record operators: filters, projections, flattening, masking, re-keying.

All of them are narrow transformations (no shuffle) and accept batch or
streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.constants import LOYALTY_FACTOR
from tillstream.functions.predicates import is_home_delivery, is_prime
from tillstream.schemas import HADOOP_COLUMNS


def shipment_filter(df: DataFrame) -> DataFrame:
    """Invoices to ship: deliveryType equals HOME-DELIVERY, ignoring case."""
    return df.where(is_home_delivery("deliveryType"))


def prime_filter(df: DataFrame) -> DataFrame:
    """Invoices of PRIME customers, ignoring case."""
    return df.where(is_prime("customerType"))


def hadoop_records(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten invoices into one record per line item (empty arrays emit nothing).

    city/state/pinCode are filled only for home deliveries. ``keep`` names
    extra input columns to carry along (e.g. the message key).
    """
    home = is_home_delivery("deliveryType")
    addr = F.col("deliveryAddress")
    lines = df.select(
        *keep,
        "invoiceNumber", "createdTime", "storeID", "posID", "customerType", "paymentMethod",
        "deliveryType",
        F.when(home, addr.getField("city")).alias("city"),
        F.when(home, addr.getField("state")).alias("state"),
        F.when(home, addr.getField("pinCode")).alias("pinCode"),
        F.explode("invoiceLineItems").alias("_li"),
    )
    return lines.select(*keep, *[c if c in lines.columns else F.col(f"_li.{c}").alias(c)
                                 for c in HADOOP_COLUMNS])


def hadoop_records_from_lines(headers: DataFrame, lines: DataFrame, header_key: str = "k",
                              line_key: str = "l_orderkey",
                              keep: tuple[str, ...] = ()) -> DataFrame:
    """The same records from invoice headers and flat line rows (the table form).

    A join on the invoice key instead of nesting lines into arrays and
    exploding them: no invoice's lines are ever gathered into one value, and a
    hot invoice key is a skewed join partition that AQE can split. Equal to
    ``hadoop_records`` of the nested invoices (an invoice without lines emits
    nothing in both).
    """
    home = is_home_delivery("deliveryType")
    addr = F.col("deliveryAddress")
    h = headers.select(
        *keep, F.col(header_key).alias("_hk"),
        "invoiceNumber", "createdTime", "storeID", "posID", "customerType", "paymentMethod",
        "deliveryType",
        F.when(home, addr.getField("city")).alias("city"),
        F.when(home, addr.getField("state")).alias("state"),
        F.when(home, addr.getField("pinCode")).alias("pinCode"))
    item_cols = [c for c in HADOOP_COLUMNS if c in lines.columns]
    j = h.join(lines.select(F.col(line_key).alias("_lk"), *item_cols),
               F.col("_hk") == F.col("_lk"), "inner")
    return j.select(*keep, *HADOOP_COLUMNS)


def mask_invoice(df: DataFrame) -> DataFrame:
    """Remove personal data: card number always; address line and contact number
    of home deliveries. Other columns, including the line array, are unchanged."""
    addr = F.col("deliveryAddress")
    masked = addr.withField("addressLine", F.lit(None).cast("string")) \
                 .withField("contactNumber", F.lit(None).cast("string"))
    return (df.withColumn("customerCardNo", F.lit(None).cast("string"))
              .withColumn("deliveryAddress",
                          F.when(is_home_delivery("deliveryType") & addr.isNotNull(), masked)
                           .otherwise(addr)))


def earned_points(amount="totalAmount"):
    """Earned points: amount × factor, in DOUBLE arithmetic."""
    x = F.col(amount) if isinstance(amount, str) else amount
    return x * F.lit(float(LOYALTY_FACTOR))


def notification(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Invoice -> loyalty notification; totalLoyaltyPoints is left unset (null)."""
    return df.select(
        *keep,
        "invoiceNumber", "customerCardNo", "totalAmount",
        earned_points().alias("earnedLoyaltyPoints"),
        F.lit(None).cast("double").alias("totalLoyaltyPoints"),
    )


def key_by(df: DataFrame, col: str) -> DataFrame:
    """Set the message key column from a value column (e.g. the customer card)."""
    return df.withColumn("key", F.col(col))


def flatten_address(df: DataFrame) -> DataFrame:
    """Invoice with the address struct spread into columns and the line array
    replaced by its size: a flat view for tabular sinks and comparisons."""
    cols = [c for c in df.columns if c not in ("deliveryAddress", "invoiceLineItems")]
    out = [F.col(c) for c in cols]
    for f in ("addressLine", "city", "state", "pinCode", "contactNumber"):
        out.append(F.col("deliveryAddress").getField(f).alias(f))
    return df.select(*out)
