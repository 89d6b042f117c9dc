"""User documents: flatten (N1), stamp (N2), keyed append (J1), latest
snapshot (W2), snapshot split (N3), records to JSON (N4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas

CREATED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _parsed(text_col: str, schema):
    """The JSON text as a struct; text that does not parse fails the job."""
    return F.from_json(F.col(text_col), schema, {"mode": "FAILFAST"})


def flatten_users(docs: DataFrame, text_col: str | None = "value") -> DataFrame:
    """Nested user document -> id, firstname, lastname, email.

    ``docs`` holds either JSON text in ``text_col`` or USER_DOC columns
    (``text_col=None``). A missing ``personalInfo`` gives NULL names.
    """
    if text_col is not None:
        docs = docs.select(_parsed(text_col, schemas.USER_DOC).alias("d")).select("d.*")
    return docs.select(
        F.col("id"),
        F.col("personalInfo.firstName").alias("firstname"),
        F.col("personalInfo.lastName").alias("lastname"),
        F.col("personalInfo.email").alias("email"),
    )


def stamp_created(df: DataFrame, ts=None, as_text: bool = True) -> DataFrame:
    """created_at = ts (default now), as yyyy-MM-dd HH:mm:ss text."""
    if ts is None:
        stamp = F.current_timestamp()
    elif isinstance(ts, (_dt.datetime, _dt.date)):
        stamp = F.lit(ts).cast("timestamp")
    else:
        stamp = F.to_timestamp(F.lit(str(ts)))
    return df.withColumn("created_at", F.date_format(stamp, CREATED_AT_FORMAT) if as_text else stamp)


def to_user_rows(flat: DataFrame) -> DataFrame:
    """Flat users -> the USERS table columns in table order. ``id`` text is
    cast to INT; with ANSI mode a non-numeric id fails the job instead of
    loading NULL keys."""
    created = F.col("created_at")
    if dict(flat.dtypes).get("created_at") == "string":
        created = F.to_timestamp(created, CREATED_AT_FORMAT)
    return flat.select(F.col("id").cast("int").alias("id"),
                       F.col("firstname").alias("firstName"),
                       F.col("lastname").alias("lastName"),
                       F.col("email"),
                       created.alias("created_at"))


def dedupe_by_key(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per key, deterministically (the smallest row by its other
    columns). A grouped min with a map-side partial step: a repeated key is
    combined in every task before the shuffle."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_r")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def require_key(df: DataFrame, key: str = "id") -> DataFrame:
    """``df``, failing the job on a NULL key as a primary key would."""
    value = F.col(key)
    text = F.raise_error(F.lit(f"a row has no {key}"))
    return df.withColumn(key, F.coalesce(value, text.cast(df.schema[key].dataType)))


def new_rows_by_key(batch: DataFrame, existing: DataFrame | None, key: str = "id") -> DataFrame:
    """Rows of ``batch`` whose key is not yet in ``existing`` (each key
    once). A row without a key fails the job. The batch is deduplicated by a
    partial aggregate on the key, which the anti-join's shuffle then reuses;
    of the stored table only the key column is read. Where the stored keys
    are few, AQE turns the join into a broadcast at run time."""
    fresh = dedupe_by_key(require_key(batch, key), key)
    if existing is None:
        return fresh
    return fresh.join(existing.select(key), key, "left_anti")


def latest_snapshot(snapshots: DataFrame, as_of=None, keys=("user_id",),
                    ts_col: str = "snapshot_ts", tiebreak: str | None = "snapshot_id") -> DataFrame:
    """Per key, the latest snapshot taken at or before ``as_of``.

    A grouped max over struct(ts, tiebreak, payload): partial aggregation
    keeps one row per key per task, so a key with millions of snapshots is
    combined before the shuffle. With ``keys=()`` it is the single latest
    snapshot overall. Ties on ts go to the larger ``tiebreak``.
    """
    df = snapshots
    if as_of is not None:
        # Wall-clock text cast to the column's own type: the bound means the
        # same on a timestamp_ntz column whatever the session time zone, and
        # no cast lands on the column (the predicate reaches the scan).
        bound = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else str(as_of)
        ts_type = df.schema[ts_col].dataType.simpleString()
        df = df.filter(F.col(ts_col) <= F.lit(bound).cast(ts_type))
    keys = list(keys)
    order = [ts_col] + ([tiebreak] if tiebreak else [])
    payload = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order + payload])).alias("_s")
    agg = df.groupBy(*keys).agg(best) if keys else df.agg(best)
    return agg.filter(F.col("_s").isNotNull()) \
              .select(*keys, *[F.col(f"_s.{c}").alias(c) for c in order + payload])


def first_result(snapshot: DataFrame, keys, text_col: str | None) -> DataFrame:
    """The keys and the document's first result as one struct, parsed once."""
    # get() gives NULL for an empty array; [0] would fail under ANSI mode.
    results = _parsed(text_col, schemas.SNAPSHOT_DOC)["results"] if text_col else F.col("results")
    return snapshot.select(*keys, F.get(results, 0).alias("_first"))


def split_snapshot(snapshot: DataFrame, keys=("user_id", "snapshot_ts"), text_col: str | None = "doc",
                   drop_fields=()) -> tuple[DataFrame, DataFrame]:
    """First result -> (location, login) datasets, flattened one level.

    Every field is kept, as in the original; ``drop_fields`` removes named
    login fields (e.g. the clear-text secret). An empty ``results`` array
    gives NULL fields, not an error. Each dataset evaluates ``snapshot`` for
    itself: pass a written table (see ``store_split``) to do it once.
    """
    snapshot = first_result(snapshot, list(keys), text_col)
    first = F.col("_first")
    keys = list(keys)
    loc = first["location"]
    location = snapshot.select(
        *keys,
        loc["street"]["number"].alias("street_number"),
        loc["street"]["name"].alias("street_name"),
        loc["city"].alias("city"), loc["state"].alias("state"),
        loc["country"].alias("country"), loc["postcode"].alias("postcode"),
        loc["coordinates"]["latitude"].alias("latitude"),
        loc["coordinates"]["longitude"].alias("longitude"),
        loc["timezone"]["offset"].alias("timezone_offset"),
        loc["timezone"]["description"].alias("timezone_description"))
    login_fields = [f.name for f in schemas.LOGIN.fields if f.name not in set(drop_fields)]
    login = snapshot.select(*keys, *[first["login"][f].alias(f) for f in login_fields])
    return location, login


def store_split(snapshot: DataFrame, path: str, keys=("user_id", "snapshot_ts"),
                text_col: str | None = "doc", drop_fields=()) -> tuple[DataFrame, DataFrame]:
    """N3 with one evaluation: the parsed first results are written to
    ``path``, and both datasets read the fields they need from there."""
    parsed = snapshot.select(*keys, (_parsed(text_col, schemas.SNAPSHOT_DOC)["results"] if text_col
                                     else F.col("results")).alias("results"))
    parsed.write.mode("overwrite").parquet(path)
    stored = snapshot.sparkSession.read.schema(parsed.schema).parquet(path)
    return split_snapshot(stored, keys, None, drop_fields)


def records_to_json(df: DataFrame, col: str = "json") -> DataFrame:
    """One JSON object per record (NDJSON lines)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias(col))
