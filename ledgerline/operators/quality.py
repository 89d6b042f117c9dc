"""Quality profile (A12, A13) and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.bands import BULK_QUANTITY, HIGH_VALUE_ORDER
from ledgerline.functions.calendar import as_date
from ledgerline.functions.money import money_sum

# The issue counts the reference sums for its gate, and the
# tolerance used by the rounded calculation check.
DEFAULT_GATE_ON = ("null_order_ids", "invalid_quantities", "invalid_prices", "calculation_errors")
CALC_TOLERANCE = 0.005


class QualityGateError(ValueError):
    """Raised by a failing gate."""


def quality_profile(df: DataFrame, date=None) -> DataFrame:
    """Eleven metrics in one aggregate pass (plus the tolerant
    calculation check). Counts only TRUE predicates, like COUNTIF."""
    if date is not None:
        df = df.filter(F.col("order_date") == as_date(date))
    return df.agg(*_profile_columns())


def _profile_columns():
    q, p, amt = F.col("quantity"), F.col("price"), F.col("total_amount")
    return [
        F.count_if(F.col("order_id").isNull()).alias("null_order_ids"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"),
        F.count_if(F.col("product").isNull()).alias("null_products"),
        F.count_if(q <= 0).alias("invalid_quantities"),
        F.count_if(p <= 0).alias("invalid_prices"),
        F.count_if(amt != q * p).alias("calculation_errors"),
        F.count_if(F.abs(amt - q * p) > F.lit(CALC_TOLERANCE)).alias("calculation_errors_tol"),
        F.count_if(amt > HIGH_VALUE_ORDER).alias("high_value_orders"),
        F.count_if(q > BULK_QUANTITY).alias("bulk_orders"),
        F.count(F.lit(1)).alias("total_records"),
        F.min(amt).alias("min_revenue"),
        F.max(amt).alias("max_revenue"),
    ]


def quality_struct(profile: DataFrame) -> DataFrame:
    """The nested result (issues / flags / range); NULL range -> 0."""
    return profile.select(
        "total_records",
        F.struct("null_order_ids", "null_customer_ids", "null_products", "invalid_quantities",
                 "invalid_prices", "calculation_errors").alias("data_issues"),
        F.struct("high_value_orders", "bulk_orders").alias("business_flags"),
        F.struct(F.coalesce("min_revenue", F.lit(0.0)).alias("min"),
                 F.coalesce("max_revenue", F.lit(0.0)).alias("max")).alias("revenue_range"),
    )


def critical_issues(exact: bool = True, gate_on=DEFAULT_GATE_ON):
    cols = [("calculation_errors" if exact else "calculation_errors_tol")
            if c == "calculation_errors" else c for c in gate_on]
    expr = F.lit(0).cast("bigint")
    for c in cols:
        expr = expr + F.col(c)
    return expr


def quality_gate(profile: DataFrame, exact: bool = True, gate_on=DEFAULT_GATE_ON) -> dict:
    """G4 + G2: raise if the summed critical issues are above 0, then if
    there are no rows (that order, as in the original). Returns the nested
    result as a dict; the profile is one row, so ``first()`` is bounded."""
    row = profile.select("*", critical_issues(exact, gate_on).alias("_issues")).first()
    if row["_issues"] > 0:
        raise QualityGateError(f"Data quality issues found: {row['_issues']} records with problems")
    if row["total_records"] == 0:
        raise QualityGateError("No records found for transformation")
    return {
        "total_records": row["total_records"],
        "data_issues": {c: row[c] for c in ("null_order_ids", "null_customer_ids", "null_products",
                                            "invalid_quantities", "invalid_prices",
                                            "calculation_errors")},
        "business_flags": {c: row[c] for c in ("high_value_orders", "bulk_orders")},
        "revenue_range": {"min": float(row["min_revenue"] or 0),
                          "max": float(row["max_revenue"] or 0)},
    }


def gates(df: DataFrame, exact: bool = True, gate_on=DEFAULT_GATE_ON) -> DataFrame:
    """G1-G4 as rows (gate, value, passed) from one aggregate pass, unpivoted
    with ``stack``. The sum-is-zero gate treats an empty frame's NULL sum
    as 0, like the frame library."""
    prof = df.agg(*_profile_columns(),
                  F.coalesce(money_sum("total_amount"), F.lit(0.0)).alias("revenue_sum"))
    issues = critical_issues(exact, gate_on).cast("double")
    wide = prof.select(
        F.col("revenue_sum"), F.col("total_records").cast("double").alias("rows"),
        issues.alias("issues"))
    return wide.select(F.expr(
        "stack(4,"
        " 'nonzero_revenue', revenue_sum, revenue_sum != 0,"
        " 'has_rows', rows, rows > 0,"
        " 'non_negative_revenue', revenue_sum, revenue_sum >= 0,"
        " 'no_critical_issues', issues, issues = 0)"
        " AS (gate, value, passed)"))


def raise_on_failed(gates_df: DataFrame) -> None:
    """Thin wrapper: raise on the first failed gate (4 rows to the driver)."""
    for row in gates_df.filter(~F.col("passed")).limit(4).collect():
        raise QualityGateError(f"gate {row['gate']} failed (value {row['value']})")
