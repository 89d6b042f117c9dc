"""Readers. Every reader declares its schema; nothing is inferred."""

from ledgerline.sources.files import (  # noqa: F401
    read_raw_json, read_sales_csv, read_snapshots, read_user_docs,
)
from ledgerline.sources.generate import generate_sales, generate_sales_for  # noqa: F401
from ledgerline.sources.tables import scan_sales  # noqa: F401
