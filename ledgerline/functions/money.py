"""Money aggregates.

Amounts are FLOAT64 without a scale rule. They are summed exactly to
``SCALE`` decimals as two BIGINT sums, whole units and the fraction in
1e-SCALE steps: exact, independent of row order (a DOUBLE sum depends on how
the partial aggregates are combined), and primitive adds inside whole-stage
codegen. A DECIMAL sum would add a ``java.math.BigDecimal`` per row per
aggregate. Per group, the two sums meet in a DECIMAL whose cast to DOUBLE is
correctly rounded, so the result equals
``CAST(SUM(CAST(x AS DECIMAL(38,6))) AS DOUBLE)``.

An amount with more decimals than that fails the job instead of being
rounded away (up to 1e9; beyond it a DOUBLE's own spacing exceeds the
steps). With ANSI mode on, a sum beyond BIGINT fails too.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6
STEPS = 10 ** SCALE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def whole(col) -> Column:
    return F.floor(_c(col)).cast("bigint")


def fraction(col) -> Column:
    """The part above ``whole`` in steps, 0 to STEPS."""
    x = _c(col).cast("double")
    steps = (x - F.floor(x)) * F.lit(float(STEPS))
    near = F.rint(steps)
    off = (F.abs(x) < F.lit(1e9)) & (F.abs(steps - near) > F.lit(1e-2) + F.abs(x) * F.lit(1e-9))
    return F.when(off, F.raise_error(F.concat(
        F.lit(f"amount with more than {SCALE} decimals: "), x.cast("string"))).cast("bigint")
    ).otherwise(near.cast("bigint"))


def as_money(wholes: Column, fractions: Column) -> Column:
    """The two sums as one DOUBLE."""
    total = (wholes.cast("decimal(20,0)") + fractions.cast("decimal(20,0)") / F.lit(STEPS).cast("decimal(7,0)"))
    return total.cast("double")


def money_sum(col) -> Column:
    return as_money(F.sum(whole(col)), F.sum(fraction(col)))


def money_avg(col) -> Column:
    """Exact sum over the non-null count, like AVG."""
    c = _c(col)
    return money_sum(c) / F.count(c).cast("double")


def money_sum_if(cond: Column, col) -> Column:
    """SUM(CASE WHEN cond THEN x ELSE 0 END)."""
    zero = F.lit(0).cast("bigint")
    return as_money(F.sum(F.when(cond, whole(col)).otherwise(zero)),
                    F.sum(F.when(cond, fraction(col)).otherwise(zero)))
