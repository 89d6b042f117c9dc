"""Fixed parameters of the registered queries (the test data's as-of date
and windows; see SURVEY 7.2)."""

import datetime as _dt

AS_OF = _dt.date(1997, 8, 23)
WINDOW_START = AS_OF - _dt.timedelta(days=30)
YESTERDAY = AS_OF - _dt.timedelta(days=1)
MONTH_START = AS_OF.replace(day=1)
BACKFILL = (_dt.date(1997, 1, 1), _dt.date(1997, 12, 31))
RETENTION_DAYS = 90
RETENTION_CUTOFF = AS_OF - _dt.timedelta(days=RETENTION_DAYS)
SNAPSHOT_AS_OF = _dt.datetime(2024, 1, 20, 0, 0, 0)
EXISTING_SEGMENT = "BUILDING"
SEED = 42
USER_STAMP = _dt.datetime(2025, 6, 17, 4, 24, 45)
EVENT_DAY_TEXT = "2024-01-15T06:00:00"
CLUSTER_REGION = "West"
CLUSTER_PRODUCT_PREFIX = "old"
LARGE_ORDER = 450_000
STORED_SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY")
