"""Writers (K1-K13). Each ends in one write action."""

from ledgerline.sinks.files import (  # noqa: F401
    append_by_key, backup, expire, land_raw, truncate_table, write_csv, write_raw,
    write_report, write_summary, write_transformed,
)
