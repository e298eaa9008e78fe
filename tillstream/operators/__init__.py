"""DataFrame -> DataFrame operators of the invoice fan-out (batch or streaming input)."""

from tillstream.operators.enrichment import (
    assemble_invoices, attach_address, enrich_lines, invoice_totals, recompute_item_totals,
    with_line_totals, with_taxes,
)
from tillstream.operators.loyalty import (
    loyalty_changelog, loyalty_latest, loyalty_reduce, running_total,
)
from tillstream.operators.metrics import intake_summary, observe_intake
from tillstream.operators.stateless import (
    flatten_address, hadoop_records, hadoop_records_from_lines, key_by, mask_invoice,
    notification, prime_filter, shipment_filter,
)
from tillstream.operators.store_sales import (
    closed_windows, hopping_store_sales, rekey_by_store, tumbling_store_sales, unwindowed,
    windowed_store_sales,
)

__all__ = [
    "assemble_invoices", "attach_address", "enrich_lines", "invoice_totals",
    "recompute_item_totals", "with_line_totals", "with_taxes",
    "loyalty_changelog", "loyalty_latest", "loyalty_reduce", "running_total",
    "intake_summary", "observe_intake", "flatten_address", "hadoop_records",
    "hadoop_records_from_lines", "key_by", "mask_invoice", "notification", "prime_filter",
    "shipment_filter", "closed_windows", "hopping_store_sales", "rekey_by_store",
    "tumbling_store_sales", "unwindowed", "windowed_store_sales",
]
