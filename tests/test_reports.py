import datetime as dt

import pytest

from ledgerline.operators.enrich import derive_sales, enrich, fill_nulls
from ledgerline.operators.quality import (
    QualityGateError, gates, quality_gate, quality_profile, quality_struct, raise_on_failed,
)
from ledgerline.operators.reports import (
    current_month_sales, daily_summary, load_stats, product_performance, revenue_variance,
    sales_report, top_customers, top_product,
)
from tests.conftest import raw_rows

D2 = dt.date(2024, 1, 15)


def test_golden_report(golden):
    rep = sales_report(fill_nulls(derive_sales(golden))).first()
    assert rep.date == "2024-01-15"
    assert rep.total_orders == 5
    assert rep.total_revenue == pytest.approx(319.91)
    assert rep.average_order_value == pytest.approx(63.982)
    assert rep.top_product == "Widget A"
    assert rep.unique_customers == 5


def test_top_product_tie_goes_to_first_name(spark):
    df = spark.createDataFrame([("B", 2), ("A", 1), ("A", 1), ("C", 1)], "product string, quantity long")
    assert top_product(df).first().top_product == "A"


def test_daily_summary_edges(edge_raw):
    enr = enrich(edge_raw, keep_invalid=True, stamp=False)
    s = daily_summary(enr, D2, D2).first()
    assert s.total_orders == 9
    assert s.north_region_revenue == pytest.approx(50.0)
    # 'Mars' region is in no named column; NOT IN leaves 'Other' products in other_revenue
    assert s.data_quality_issues_count == 3
    assert s.other_revenue == pytest.approx(0.0)
    assert s.unique_customers == 6    # 100..105; the NULL customer is not counted


def test_load_stats_empty_date_is_zero(edge_raw):
    row = load_stats(enrich(edge_raw, stamp=False), dt.date(2030, 1, 1)).first()
    assert (row.row_count, row.total_revenue, row.avg_order_value, row.unique_customers) == (0, 0.0, 0.0, 0)


def test_top_customers_and_views(spark):
    rows = [(i, 100 + i % 3, "Widget A", 1, 60.0, 60.0, dt.date(2024, 1, 1 + i % 28), "North", "Online")
            for i in range(30)]
    rows.append((99, 200, "Gadget X", 1, 60.0, 60.0, dt.date(2023, 1, 1), "North", "Online"))
    enr = enrich(raw_rows(spark, rows), stamp=False)
    top = top_customers(enr, dt.date(2024, 1, 31)).collect()
    assert [r.customer_id for r in top] == [100, 101, 102]
    assert top[0].order_count == 10
    cm = current_month_sales(enr, dt.date(2024, 1, 15)).collect()
    assert [r.order_date.day for r in cm] == list(range(1, 16))
    pp = product_performance(enr, dt.date(2024, 1, 31)).collect()
    assert len(pp) == 1 and pp[0].times_sold == 30


def test_quality_profile_and_gate(edge_raw):
    prof = quality_profile(edge_raw)
    r = prof.first()
    assert r.null_order_ids == 1 and r.null_customer_ids == 1 and r.null_products == 1
    assert r.invalid_quantities == 2 and r.invalid_prices == 1
    assert r.high_value_orders == 1 and r.bulk_orders == 1 and r.total_records == 10
    nested = quality_struct(prof).first()
    assert nested.data_issues.null_order_ids == 1
    with pytest.raises(QualityGateError, match="Data quality issues found"):
        quality_gate(prof)
    # empty input: the issue check passes first, then "no rows" fires
    with pytest.raises(QualityGateError, match="No records"):
        quality_gate(quality_profile(edge_raw.limit(0)))


def test_gate_tolerance(spark):
    rows = [(1, 1, "Widget A", 3, 19.99, round(3 * 19.99, 2), D2, "North", "Online")]
    prof = quality_profile(raw_rows(spark, rows))
    r = prof.first()
    assert r.calculation_errors_tol == 0
    quality_gate(prof, exact=False)


def test_gates_frame(edge_raw, golden):
    rows = {r.gate: r.passed for r in gates(edge_raw).collect()}
    assert rows == {"nonzero_revenue": True, "has_rows": True, "non_negative_revenue": True,
                    "no_critical_issues": False}
    empty = {r.gate: r.passed for r in gates(edge_raw.limit(0)).collect()}
    assert empty["nonzero_revenue"] is False and empty["has_rows"] is False
    raise_on_failed(gates(derive_sales(golden)))


def test_revenue_variance(spark):
    rows = [(i, 1, "Widget A", 1, float(10 * (i + 1)), float(10 * (i + 1)), dt.date(2024, 1, 1 + i),
             "North", "Online") for i in range(3)]
    rows.append((9, 1, "Widget A", 1, 5.0, 5.0, dt.date(2024, 1, 10), "North", "Online"))
    out = {r.order_date.day: r for r in revenue_variance(raw_rows(spark, rows), 5.0).collect()}
    assert out[2].variance == 10.0 and out[2].exceeds
    assert out[1].previous_revenue is None and out[10].variance is None
