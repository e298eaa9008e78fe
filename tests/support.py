"""Constants and row builders shared by the tests (not a conftest, so that its name is its own)."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

INVOICE_DDL = (
    "key string, invoiceNumber string, createdTime bigint, customerCardNo string, "
    "totalAmount double, numberOfItems int, paymentMethod string, taxableAmount double, "
    "cgst double, sgst double, cess double, storeID string, posID string, cashierID string, "
    "customerType string, deliveryType string, "
    "deliveryAddress struct<addressLine:string,city:string,state:string,pinCode:string,"
    "contactNumber:string>, "
    "invoiceLineItems array<struct<itemCode:string,itemDescription:string,itemPrice:double,"
    "itemQty:int,totalValue:double>>, k bigint, event_time timestamp")


def make_invoice(n, card, amount, ctype, dtype, addr=None, lines=(), minute=0, store="S1"):
    from datetime import datetime, timedelta, timezone
    t = datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(minutes=minute)
    return (card, str(n), int(t.timestamp() * 1000), card, amount, len(lines), "CASH", amount,
            None, None, None, store, "P1", "C1", ctype, dtype, addr, list(lines), n,
            t.replace(tzinfo=None))
