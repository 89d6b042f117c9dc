"""Column expressions. All built-in Spark functions: no UDFs, codegen-friendly."""

from ledgerline.functions.bands import (  # noqa: F401
    binary_category, has_quality_issues, order_category, product_category,
)
from ledgerline.functions.calendar import (  # noqa: F401
    as_date, day_of_week, month_of, month_start, quarter_of, days_before,
)
from ledgerline.functions.money import money_avg, money_sum, money_sum_if  # noqa: F401
