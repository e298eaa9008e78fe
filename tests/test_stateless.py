from pyspark.sql import functions as F

from tillstream.operators import stateless
from tillstream.operators.store_sales import rekey_by_store


def test_shipment_filter_ignores_case_and_drops_null_type(invoices):
    got = sorted(r.invoiceNumber for r in stateless.shipment_filter(invoices).collect())
    assert got == ["1", "2", "5"]


def test_prime_filter(invoices):
    got = sorted(r.invoiceNumber for r in stateless.prime_filter(invoices).collect())
    assert got == ["1", "2", "4", "6"]


def test_hadoop_records_flatten_and_conditional_address(invoices):
    out = stateless.hadoop_records(invoices, keep=("key",))
    rows = out.collect()
    # 2 + 1 + 1 + 0 (empty array emits nothing) + 2 + 1
    assert len(rows) == 7
    assert set(out.columns[1:]) == set(stateless.HADOOP_COLUMNS)
    by_inv = {}
    for r in rows:
        by_inv.setdefault(r.invoiceNumber, []).append(r)
    assert all(r.city == "Pune" and r.pinCode == "411001" for r in by_inv["1"])
    assert all(r.city is None and r.state is None for r in by_inv["3"] + by_inv["6"])
    # home delivery without an address: nulls, no error
    assert all(r.city is None for r in by_inv["5"])
    assert sorted(r.totalValue for r in by_inv["1"]) == [25.5, 200.0]


def test_mask_invoice(invoices):
    out = {r.invoiceNumber: r for r in stateless.mask_invoice(invoices).collect()}
    assert all(r.customerCardNo is None for r in out.values())
    a = out["1"].deliveryAddress
    assert a.addressLine is None and a.contactNumber is None and a.city == "Pune"
    assert out["5"].deliveryAddress is None
    assert len(out["1"].invoiceLineItems) == 2


def test_notification_projection(invoices):
    out = {r.invoiceNumber: r for r in stateless.notification(invoices).collect()}
    assert out["1"].earnedLoyaltyPoints == 4.0
    assert out["4"].earnedLoyaltyPoints == 1.9998
    assert out["1"].totalLoyaltyPoints is None


def test_rekey_by_store_keeps_rows(invoices):
    out = rekey_by_store(invoices)
    assert out.count() == invoices.count()
    assert out.where(F.col("key") != F.col("storeID")).count() == 0


def test_intake_metrics_observed_and_summarised(spark, invoices):
    from pyspark.sql import Observation
    from tillstream.operators.metrics import intake_summary, observe_intake
    obs = Observation("intake")
    observe_intake(invoices, obs).write.format("noop").mode("overwrite").save()
    m = obs.get
    assert m["intake_rows"] == 6 and m["null_delivery_type"] == 1
    assert m["null_customer_type"] == 1 and m["home_deliveries"] == 3 and m["prime_invoices"] == 4
    assert m["intake_amount"] == 385.99
    assert intake_summary(invoices).first().asDict() == m


def test_output_schemas_match_declared_records(invoices):
    from tillstream.schemas import HADOOP_RECORD, NOTIFICATION, STORE
    from tillstream.operators import store_sales

    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    assert shape(stateless.hadoop_records(invoices).schema) == shape(HADOOP_RECORD)
    assert shape(stateless.notification(invoices).schema) == shape(NOTIFICATION)
    ev = invoices.select("storeID", "totalAmount", "event_time")
    assert shape(store_sales.unwindowed(store_sales.hopping_store_sales(ev)).schema) == shape(STORE)


def test_flat_and_nested_flatten_agree(spark):
    from support import SF001
    from tillstream.session import utc
    from tillstream.sources import adapters
    with utc(spark):
        nested = stateless.hadoop_records(adapters.invoices(spark, SF001, lines=True), keep=("key",))
        flat = stateless.hadoop_records_from_lines(
            adapters.invoices(spark, SF001, lines=False), adapters.invoice_lines(spark, SF001),
            keep=("key",))
        assert nested.columns == flat.columns
        assert nested.exceptAll(flat).count() == 0 and flat.exceptAll(nested).count() == 0


def test_nested_line_totals_equal_flat(spark):
    from support import SF001
    from tillstream.operators.enrichment import recompute_item_totals, with_line_totals
    from tillstream.session import utc
    from tillstream.sources import adapters
    with utc(spark):
        inv = recompute_item_totals(adapters.invoices(spark, SF001, lines=True))
        nested = inv.select("invoiceNumber", F.explode("invoiceLineItems").alias("li")).select(
            "invoiceNumber", "li.itemCode", "li.itemPrice", "li.itemQty", "li.totalValue")
        flat = with_line_totals(adapters.invoice_lines(spark, SF001)).select(
            F.col("l_orderkey").cast("string").alias("invoiceNumber"), "itemCode", "itemPrice",
            "itemQty", "totalValue")
        assert nested.exceptAll(flat).count() == 0 and flat.exceptAll(nested).count() == 0


def test_odd_amounts_reach_the_sum(spark):
    """Nothing is skipped: NaN and infinity come out as in DOUBLE addition, nulls count nothing."""
    import math
    from tillstream.functions.money import money_sum
    def total(*values):
        df = spark.createDataFrame([(x,) for x in values], "a double")
        return df.agg(money_sum("a").alias("s")).first().s
    assert math.isnan(total(1.25, float("nan"), None))
    assert total(1.25, float("inf"), None) == float("inf")
    assert total(1.25, 1e300, None) == 1e300
    assert total(1.25, None) == 1.25
