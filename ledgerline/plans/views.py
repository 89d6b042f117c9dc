"""The three reporting views as temp views over a transformed frame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.operators.reports import current_month_sales, product_performance, top_customers


def register_views(transformed: DataFrame, as_of) -> dict[str, DataFrame]:
    views = {
        "current_month_sales": current_month_sales(transformed, as_of),
        "top_customers": top_customers(transformed, as_of),
        "product_performance": product_performance(transformed, as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
