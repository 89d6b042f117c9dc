"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHECKED: dict = {}


def fits(df: DataFrame, max_rows: int, cache_key=None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``limit(max_rows + 1).count()`` runs a local limit in every task: each
    task stops reading after max_rows + 1 rows and only a count reaches the
    driver. The check therefore reads at most one pass over ``df`` and at
    most tasks x (max_rows + 1) rows, so it belongs on the side that is meant
    to be small (a dimension table, an incoming batch), never on the large
    table it is joined to. ``cache_key``
    (e.g. the table path) remembers the answer for the life of the
    application, so a static dimension table is checked once.
    """
    key = (df.sparkSession.sparkContext.applicationId, cache_key, max_rows) if cache_key else None
    small = _CHECKED.get(key) if key else None
    if small is None:
        small = df.limit(max_rows + 1).count() <= max_rows
        if key:
            _CHECKED[key] = small
    return small


def broadcast_if_small(df: DataFrame, max_rows: int, cache_key=None) -> DataFrame:
    """Broadcast hint only after ``fits`` proves the row bound. Above the
    bound the frame is returned unhinted and the planner / AQE picks a
    shuffle join."""
    return F.broadcast(df) if fits(df, max_rows, cache_key) else df
