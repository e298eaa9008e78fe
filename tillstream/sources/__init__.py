"""Inputs: driver tables, the invoice adapter, invoice streams and codecs, dimension files."""

from tillstream.sources.tables import read_table, TABLES
from tillstream.sources.adapters import (
    invoices, invoice_lines, invoice_headers, store_events,
)

__all__ = ["read_table", "TABLES", "invoices", "invoice_lines", "invoice_headers", "store_events"]
