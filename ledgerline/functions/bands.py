"""Business bands and flags as CASE expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results:
# value band thresholds and labels, product-name patterns and labels,
# the binary category label, the profit margin, and the business-rule limits.
HIGH_VALUE_MIN = 100
MEDIUM_VALUE_MIN = 50
VALUE_LABELS = ("High Value", "Medium Value", "Low Value")
PRODUCT_PATTERNS = (("%Widget%", "Widgets"), ("%Gadget%", "Gadgets"))
PRODUCT_OTHER = "Other"
BINARY_MARKER = "Widget"
BINARY_LABELS = ("Electronics", "Other")
PROFIT_MARGIN = 0.3
HIGH_VALUE_ORDER = 1000
BULK_QUANTITY = 10


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def order_category(amount="total_amount") -> Column:
    """>= 100 High, >= 50 Medium, else (also NULL) Low."""
    a = _c(amount)
    high, medium, low = VALUE_LABELS
    return (F.when(a >= HIGH_VALUE_MIN, high)
            .when(a >= MEDIUM_VALUE_MIN, medium)
            .otherwise(low))


def product_category(product="product") -> Column:
    """Case-sensitive LIKE bands; NULL product falls to Other."""
    p = _c(product)
    expr = None
    for pattern, label in PRODUCT_PATTERNS:
        expr = (F.when(p.like(pattern), label) if expr is None
                else expr.when(p.like(pattern), label))
    return expr.otherwise(PRODUCT_OTHER)


def binary_category(product="product") -> Column:
    """Substring test of the CSV job: contains 'Widget' -> Electronics."""
    yes, no = BINARY_LABELS
    return F.when(_c(product).contains(BINARY_MARKER), yes).otherwise(no)


def has_quality_issues(quantity="quantity", price="price") -> Column:
    """quantity <= 0 OR price <= 0; NULL comparisons give FALSE."""
    return (F.when((_c(quantity) <= 0) | (_c(price) <= 0), F.lit(True))
            .otherwise(F.lit(False)))


def estimated_profit(amount="total_amount") -> Column:
    return _c(amount) * F.lit(PROFIT_MARGIN)
