"""Structured Streaming jobs."""

from ledgerline.streaming.ingest import ingest_new_files  # noqa: F401
