"""Record schemas of the invoice data model, declared once and never inferred."""

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DELIVERY_ADDRESS = _struct(
    ("addressLine", S), ("city", S), ("state", S), ("pinCode", S), ("contactNumber", S)
)

LINE_ITEM = _struct(
    ("itemCode", S), ("itemDescription", S), ("itemPrice", D), ("itemQty", I), ("totalValue", D)
)

POS_INVOICE = T.StructType(
    [T.StructField(n, t, True) for n, t in [
        ("invoiceNumber", S), ("createdTime", L), ("customerCardNo", S), ("totalAmount", D),
        ("numberOfItems", I), ("paymentMethod", S), ("taxableAmount", D), ("cgst", D),
        ("sgst", D), ("cess", D), ("storeID", S), ("posID", S), ("cashierID", S),
        ("customerType", S), ("deliveryType", S), ("deliveryAddress", DELIVERY_ADDRESS),
    ]]
    + [T.StructField("invoiceLineItems", T.ArrayType(LINE_ITEM, True), False)]
)

HADOOP_RECORD = _struct(
    ("invoiceNumber", S), ("createdTime", L), ("storeID", S), ("posID", S),
    ("customerType", S), ("paymentMethod", S), ("deliveryType", S), ("city", S),
    ("state", S), ("pinCode", S), ("itemCode", S), ("itemDescription", S),
    ("itemPrice", D), ("itemQty", I), ("totalValue", D),
)

NOTIFICATION = _struct(
    ("invoiceNumber", S), ("customerCardNo", S), ("totalAmount", D),
    ("earnedLoyaltyPoints", D), ("totalLoyaltyPoints", D),
)

STORE = _struct(("storeID", S), ("totalSale", D))

MESSAGE_KEY = _struct(("key", S))

# Dimension files as written on disk: prices are JSON strings, codes are numbers.
PRODUCT_FILE = _struct(("itemCode", L), ("itemDescription", S), ("itemPrice", S), ("itemQty", L))
ADDRESS_FILE = DELIVERY_ADDRESS

INVOICE_COLUMNS = [f.name for f in POS_INVOICE.fields]
HADOOP_COLUMNS = [f.name for f in HADOOP_RECORD.fields]
NOTIFICATION_COLUMNS = [f.name for f in NOTIFICATION.fields]
