"""DuckDB SQL equivalents of the registered queries (the correctness gate).

The SQL runs on the driver's parquet tables registered as views. Money
sums go through a DECIMAL that holds every decimal of the amounts; every
count and integer sum is cast to BIGINT.
"""

from __future__ import annotations

from ledgerline.plans import params as P

SALES = f"""
sales AS (
  SELECT l.l_orderkey AS order_id,
         NULLIF(o.o_custkey, 0) AS customer_id,
         replace(replace(p.p_name, 'widget', 'Widget'), 'gizmo', 'Gadget') AS product,
         CAST(l.l_quantity AS BIGINT) - 1 AS quantity,
         round(p.p_retailprice - 890.0, 2) AS price,
         round((CAST(l.l_quantity AS BIGINT) - 1) * round(p.p_retailprice - 890.0, 2), 2) AS total_amount,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CASE n.n_regionkey WHEN 0 THEN 'South' WHEN 1 THEN 'West' WHEN 2 THEN 'East'
              WHEN 3 THEN 'North' ELSE 'Central' END AS region,
         CASE o.o_orderkey % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'Retail' ELSE 'Mobile' END AS channel
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

RAW_COLS = "order_id, customer_id, product, quantity, price, total_amount, order_date, region, channel"


def _d(value) -> str:
    return f"DATE '{value.isoformat()}'"


def _range(start=None, end=None, col="order_date") -> list[str]:
    out = []
    if start is not None:
        out.append(f"{col} >= {_d(start)}")
    if end is not None:
        out.append(f"{col} <= {_d(end)}")
    return out


def enriched(start=None, end=None, keep_invalid=False, name="enriched") -> str:
    where = _range(start, end)
    if not keep_invalid:
        where += ["quantity > 0", "price > 0"]
    w = ("WHERE " + " AND ".join(where)) if where else ""
    return f"""
{name} AS (
  SELECT {RAW_COLS},
    CASE WHEN total_amount >= 100 THEN 'High Value' WHEN total_amount >= 50 THEN 'Medium Value'
         ELSE 'Low Value' END AS order_category,
    CASE WHEN product LIKE '%Widget%' THEN 'Widgets' WHEN product LIKE '%Gadget%' THEN 'Gadgets'
         ELSE 'Other' END AS product_category,
    CAST(dayofweek(order_date) + 1 AS BIGINT) AS day_of_week,
    CAST(month(order_date) AS BIGINT) AS month,
    CAST(quarter(order_date) AS BIGINT) AS quarter,
    CAST(RANK() OVER (PARTITION BY customer_id ORDER BY order_date) AS BIGINT) AS customer_order_sequence,
    total_amount AS revenue,
    total_amount * 0.3 AS estimated_profit,
    CASE WHEN quantity <= 0 OR price <= 0 THEN TRUE ELSE FALSE END AS has_data_quality_issues
  FROM sales {w})"""


ENRICHED_COLS = (RAW_COLS + ", order_category, product_category, day_of_week, month, quarter, "
                 "customer_order_sequence, revenue, estimated_profit, has_data_quality_issues")


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def mavg(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE) / CAST(COUNT({x}) AS DOUBLE))"


def msum_if(cond: str, x: str = "total_amount") -> str:
    return (f"CAST(SUM(CASE WHEN {cond} THEN CAST({x} AS DECIMAL(38,6)) "
            f"ELSE CAST(0 AS DECIMAL(38,6)) END) AS DOUBLE)")


# The named regions, channels and categories of the summary.
REGION_SUMS = ",\n  ".join(msum_if(f"region = '{r}'") + f" AS {r.lower()}_region_revenue"
                           for r in ("North", "South", "East", "West"))
CHANNEL_SUMS = ",\n  ".join(msum_if(f"channel = '{c}'") + f" AS {c.lower()}_revenue"
                            for c in ("Online", "Retail", "Mobile"))
CATEGORY_SUMS = ",\n  ".join([msum_if("product_category = 'Widgets'") + " AS widgets_revenue",
                              msum_if("product_category = 'Gadgets'") + " AS gadgets_revenue",
                              msum_if("product_category NOT IN ('Widgets', 'Gadgets')")
                              + " AS other_revenue"])


def summary_sql(start=None, end=None, keep_invalid=False) -> str:
    where = _range(start, end)
    w = ("WHERE " + " AND ".join(where)) if where else ""
    return f"""WITH {SALES}, {enriched(keep_invalid=keep_invalid)}
SELECT order_date AS summary_date,
  COUNT(*) AS total_orders,
  {msum('total_amount')} AS total_revenue,
  {mavg('total_amount')} AS average_order_value,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {REGION_SUMS},
  {CHANNEL_SUMS},
  {CATEGORY_SUMS},
  CAST(SUM(CASE WHEN has_data_quality_issues THEN 1 ELSE 0 END) AS BIGINT) AS data_quality_issues_count
FROM enriched {w} GROUP BY order_date"""


CSV_DERIVED = """
csv_derived AS (
  SELECT order_id, customer_id, product, quantity, price,
         CAST(order_date AS TIMESTAMP) AS order_date,
         quantity * price AS total_amount,
         CASE WHEN contains(product, 'Widget') THEN 'Electronics' ELSE 'Other' END AS product_category
  FROM sales)"""

CSV_FILLED = """
csv_filled AS (
  SELECT COALESCE(order_id, 0) AS order_id, COALESCE(customer_id, 0) AS customer_id,
         COALESCE(product, '0') AS product, COALESCE(quantity, 0) AS quantity,
         COALESCE(price, 0) AS price, order_date, COALESCE(total_amount, 0) AS total_amount,
         COALESCE(product_category, '0') AS product_category
  FROM csv_derived)"""


def report_sql() -> str:
    return f"""WITH {SALES}, {CSV_DERIVED}, {CSV_FILLED},
keyed AS (SELECT *, strftime(order_date, '%Y-%m-%d') AS date FROM csv_filled),
totals AS (
  SELECT date, COUNT(*) AS total_orders, {msum('total_amount')} AS total_revenue,
         {mavg('total_amount')} AS average_order_value,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM keyed GROUP BY date),
per_product AS (SELECT date, product, COALESCE(SUM(quantity), 0) AS q FROM keyed GROUP BY date, product),
top AS (
  SELECT date, product AS top_product FROM (
    SELECT date, product, ROW_NUMBER() OVER (PARTITION BY date ORDER BY q DESC, product ASC) AS rn
    FROM per_product) WHERE rn = 1)
SELECT t.date, t.total_orders, t.total_revenue, t.average_order_value, top.top_product,
       t.unique_customers
FROM totals t JOIN top ON t.date IS NOT DISTINCT FROM top.date"""


def profile_cols() -> str:
    return """
  CAST(count_if(order_id IS NULL) AS BIGINT) AS null_order_ids,
  CAST(count_if(customer_id IS NULL) AS BIGINT) AS null_customer_ids,
  CAST(count_if(product IS NULL) AS BIGINT) AS null_products,
  CAST(count_if(quantity <= 0) AS BIGINT) AS invalid_quantities,
  CAST(count_if(price <= 0) AS BIGINT) AS invalid_prices,
  CAST(count_if(total_amount != quantity * price) AS BIGINT) AS calculation_errors,
  CAST(count_if(abs(total_amount - quantity * price) > 0.005) AS BIGINT) AS calculation_errors_tol,
  CAST(count_if(total_amount > 1000) AS BIGINT) AS high_value_orders,
  CAST(count_if(quantity > 10) AS BIGINT) AS bulk_orders,
  COUNT(*) AS total_records,
  MIN(total_amount) AS min_revenue,
  MAX(total_amount) AS max_revenue"""


def _user_names(prefix: str = "c.") -> str:
    return (f"split_part({prefix}c_name, '#', 1) AS firstname, "
            f"split_part({prefix}c_name, '#', 2) AS lastname, "
            f"lower(split_part({prefix}c_name, '#', 1) || '.' || split_part({prefix}c_name, '#', 2)"
            f" || '@example.com') AS email")


def latest_events_sql() -> str:
    return f"""latest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts <= TIMESTAMP '{P.SNAPSHOT_AS_OF.isoformat(sep=' ')}') WHERE rn = 1)"""


def oracle_sql() -> dict[str, str]:
    a, s, y = P.AS_OF, P.WINDOW_START, P.YESTERDAY
    bs, be = P.BACKFILL
    q: dict[str, str] = {}
    q["enrich_range"] = f"WITH {SALES}, {enriched(s, a)} SELECT {ENRICHED_COLS} FROM enriched"
    q["enrich_day"] = f"WITH {SALES}, {enriched(a, a)} SELECT {ENRICHED_COLS} FROM enriched"
    q["customer_order_sequence"] = (
        f"WITH {SALES}, {enriched()} SELECT customer_id, order_date, order_id, product, quantity, "
        f"customer_order_sequence FROM enriched")
    q["scan_day"] = f"WITH {SALES} SELECT {RAW_COLS} FROM sales WHERE order_date = {_d(a)}"
    q["scan_backfill"] = (f"WITH {SALES} SELECT {RAW_COLS} FROM sales "
                          f"WHERE order_date BETWEEN {_d(bs)} AND {_d(be)}")
    q["derive_total"] = (f"WITH {SALES}, {CSV_DERIVED} SELECT order_id, customer_id, product, quantity, "
                         f"price, order_date, total_amount FROM csv_derived")
    q["category_binary"] = f"WITH {SALES}, {CSV_DERIVED} SELECT order_id, product, product_category FROM csv_derived"
    q["order_category"] = (f"WITH {SALES}, {enriched(keep_invalid=True)} "
                           f"SELECT order_id, total_amount, order_category FROM enriched")
    q["product_category"] = (f"WITH {SALES}, {enriched(keep_invalid=True)} "
                             f"SELECT order_id, product, product_category FROM enriched")
    q["time_features"] = (f"WITH {SALES}, {enriched(keep_invalid=True)} "
                          f"SELECT order_id, order_date, day_of_week, month, quarter FROM enriched")
    q["profit"] = (f"WITH {SALES}, {enriched(keep_invalid=True)} "
                   f"SELECT order_id, total_amount, revenue, estimated_profit FROM enriched")
    q["quality_flag"] = (f"WITH {SALES}, {enriched(keep_invalid=True)} "
                         f"SELECT order_id, quantity, price, has_data_quality_issues FROM enriched")
    q["clean_filter"] = (f"WITH {SALES} SELECT {RAW_COLS} FROM sales WHERE order_date = {_d(a)} "
                         f"AND quantity > 0 AND price > 0")
    q["daily_summary"] = summary_sql(y, y)
    q["daily_summary_backfill"] = summary_sql()
    q["region_breakdown"] = (f"WITH {SALES}, {enriched()} SELECT order_date AS summary_date, "
                             f"{REGION_SUMS} FROM enriched GROUP BY order_date")
    q["channel_breakdown"] = (f"WITH {SALES}, {enriched()} SELECT order_date AS summary_date, "
                              f"{CHANNEL_SUMS} FROM enriched GROUP BY order_date")
    q["category_breakdown"] = (f"WITH {SALES}, {enriched()} SELECT order_date AS summary_date, "
                               f"{CATEGORY_SUMS} FROM enriched GROUP BY order_date")
    q["current_month_sales"] = f"""WITH {SALES}, {enriched()}
SELECT order_date, COUNT(*) AS orders, {msum('total_amount')} AS revenue,
       {mavg('total_amount')} AS avg_order_value
FROM enriched WHERE order_date >= {_d(P.MONTH_START)} AND order_date <= {_d(a)}
GROUP BY order_date ORDER BY order_date"""
    q["top_customers"] = f"""WITH {SALES}, {enriched()}
SELECT customer_id, COUNT(*) AS order_count, {msum('total_amount')} AS total_spent,
       {mavg('total_amount')} AS avg_order_value, MAX(order_date) AS last_order_date
FROM enriched WHERE order_date >= {_d(s)} AND order_date <= {_d(a)}
GROUP BY customer_id HAVING COUNT(*) > 1
ORDER BY total_spent DESC NULLS LAST, customer_id ASC NULLS LAST LIMIT 100"""
    q["product_performance"] = f"""WITH {SALES}, {enriched()}
SELECT product, product_category, COUNT(*) AS times_sold, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       {msum('total_amount')} AS total_revenue, {mavg('price')} AS avg_price
FROM enriched WHERE order_date >= {_d(s)} AND order_date <= {_d(a)}
GROUP BY product, product_category
ORDER BY total_revenue DESC NULLS LAST, product ASC NULLS LAST, product_category ASC NULLS LAST"""
    q["load_stats"] = f"""WITH {SALES}, {enriched()}
SELECT COUNT(*) AS row_count, COALESCE({msum('total_amount')}, 0.0) AS total_revenue,
       COALESCE({mavg('total_amount')}, 0.0) AS avg_order_value,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM enriched WHERE order_date = {_d(a)}"""
    q["sales_report"] = report_sql()
    q["top_product"] = f"""WITH {SALES}, {CSV_DERIVED}, {CSV_FILLED},
per_product AS (SELECT product, COALESCE(SUM(quantity), 0) AS q FROM csv_filled GROUP BY product)
SELECT product AS top_product FROM per_product ORDER BY q DESC, product ASC LIMIT 1"""
    q["null_fill"] = (f"WITH {SALES}, {CSV_DERIVED}, {CSV_FILLED} SELECT order_id, customer_id, product, "
                      f"quantity, price, order_date, total_amount, product_category FROM csv_filled")
    q["quality_profile"] = f"WITH {SALES}, {enriched()} SELECT {profile_cols()} FROM enriched"
    q["quality_profile_raw"] = f"WITH {SALES} SELECT {profile_cols()} FROM sales"
    q["gates"] = f"""WITH {SALES},
w AS (
  SELECT CAST(COALESCE(SUM(CAST(total_amount AS DECIMAL(38,6))), 0) AS DOUBLE) AS revenue_sum,
         CAST(COUNT(*) AS DOUBLE) AS rows_n,
         CAST(count_if(order_id IS NULL) + count_if(quantity <= 0) + count_if(price <= 0)
              + count_if(total_amount != quantity * price) AS DOUBLE) AS issues
  FROM sales)
SELECT 'nonzero_revenue' AS gate, revenue_sum AS value, revenue_sum != 0 AS passed FROM w
UNION ALL SELECT 'has_rows', rows_n, rows_n > 0 FROM w
UNION ALL SELECT 'non_negative_revenue', revenue_sum, revenue_sum >= 0 FROM w
UNION ALL SELECT 'no_critical_issues', issues, issues = 0 FROM w"""
    q["revenue_variance"] = f"""WITH {SALES}, {enriched()},
daily AS (SELECT order_date, {msum('total_amount')} AS revenue FROM enriched GROUP BY order_date)
SELECT d.order_date, d.revenue, p.revenue AS previous_revenue, d.revenue - p.revenue AS variance
FROM daily d LEFT JOIN daily p ON d.order_date = p.order_date + INTERVAL 1 DAY"""
    q["user_flatten"] = (f"SELECT CAST(c.c_custkey AS VARCHAR) AS id, {_user_names()} FROM customer c")
    q["keyed_append"] = f"""WITH batch AS (
  SELECT DISTINCT CAST(c.c_custkey AS INTEGER) AS id, {_user_names()}
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
existing AS (SELECT CAST(c_custkey AS INTEGER) AS id FROM customer WHERE c_mktsegment = '{P.EXISTING_SEGMENT}')
SELECT b.id, b.firstname AS firstName, b.lastname AS lastName, b.email FROM batch b
WHERE b.id NOT IN (SELECT id FROM existing)"""
    q["latest_snapshot"] = (f"WITH {latest_events_sql()} SELECT user_id, ts AS snapshot_ts, "
                            f"event_id AS snapshot_id FROM latest")
    q["snapshot_location"] = f"""WITH {latest_events_sql()}
SELECT user_id, ts AS snapshot_ts, event_id AS street_number, event_type AS street_name,
       'city-' || event_type AS city, 'state-' || CAST(user_id % 7 AS VARCHAR) AS state,
       'NL' AS country, CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) AS postcode,
       printf('%.2f', value) AS latitude, printf('%.2f', -value) AS longitude,
       '+1:00' AS timezone_offset, 'Central Europe' AS timezone_description
FROM latest"""
    q["snapshot_login"] = f"""WITH {latest_events_sql()}
SELECT user_id, ts AS snapshot_ts, md5(CAST(event_id AS VARCHAR)) AS uuid,
       'user' || CAST(user_id AS VARCHAR) AS username,
       substring(sha1(CAST(event_id AS VARCHAR)), 1, 10) AS password,
       substring(md5(CAST(event_id AS VARCHAR) || 'salt'), 1, 8) AS salt,
       md5('pw' || CAST(event_id AS VARCHAR)) AS md5, sha1('pw' || CAST(event_id AS VARCHAR)) AS sha1,
       sha256('pw' || CAST(event_id AS VARCHAR)) AS sha256
FROM latest"""
    q["sales_to_json"] = (f"WITH {SALES} SELECT CAST(to_json(struct_pack(order_id := order_id, "
                          f"customer_id := customer_id, product := product, quantity := quantity, "
                          f"price := price, total_amount := total_amount, order_date := order_date, "
                          f"region := region, channel := channel)) AS VARCHAR) AS json FROM sales")
    q["csv_round_trip"] = (f"WITH {SALES} SELECT order_id, customer_id, product, quantity, price, "
                           f"order_date FROM sales")
    q["incremental_ingest"] = f"WITH {SALES} SELECT {RAW_COLS} FROM sales"
    q["idempotent_summary"] = summary_sql()
    q["backup_copy"] = f"WITH {SALES}, {enriched()} SELECT {ENRICHED_COLS} FROM enriched"
    q["retention_90"] = (f"WITH {SALES}, {enriched()} SELECT {ENRICHED_COLS} FROM enriched "
                         f"WHERE order_date >= {_d(P.RETENTION_CUTOFF)}")
    q["run_status"] = f"""WITH {SALES},
rows AS (SELECT * FROM sales WHERE order_date = {_d(a)} AND quantity > 0 AND price > 0),
day AS (SELECT COUNT(*) AS n, COALESCE({msum('total_amount')}, 0.0) AS revenue FROM rows),
profile AS (SELECT {profile_cols()} FROM rows)
SELECT CASE WHEN n > 0 THEN 'success' ELSE 'error' END AS status,
       '{a.isoformat()}' AS execution_date,
       CASE WHEN n > 0 THEN n END AS records_processed,
       CASE WHEN n > 0 THEN revenue END AS total_revenue,
       CASE WHEN n > 0 THEN 'Data transformation completed successfully' END AS message,
       CASE WHEN n = 0 THEN 'No records found for transformation' END AS error,
       CASE WHEN n > 0 THEN '{{"total_records": ' || n || ', "data_issues": {{' ||
         '"null_order_ids": ' || null_order_ids || ', "null_customer_ids": ' || null_customer_ids ||
         ', "null_products": ' || null_products || ', "invalid_quantities": ' || invalid_quantities ||
         ', "invalid_prices": ' || invalid_prices || ', "calculation_errors": ' || calculation_errors ||
         '}}, "business_flags": {{"high_value_orders": ' || high_value_orders || ', "bulk_orders": ' ||
         bulk_orders || '}}, "revenue_range": {{"min": ' || min_revenue || ', "max": ' || max_revenue || '}}}}'
       END AS quality_checks
FROM day, profile"""
    q["csv_report_job"] = report_sql()
    q["user_ingest_job"] = f"""SELECT CAST(c.c_custkey AS INTEGER) AS id, split_part(c.c_name, '#', 1) AS firstName,
       split_part(c.c_name, '#', 2) AS lastName,
       lower(split_part(c.c_name, '#', 1) || '.' || split_part(c.c_name, '#', 2) || '@example.com') AS email
FROM customer c"""
    q["user_stamp"] = (f"SELECT CAST(c.c_custkey AS VARCHAR) AS id, {_user_names()}, "
                       f"'{P.USER_STAMP:%Y-%m-%d %H:%M:%S}' AS created_at FROM customer c")
    q["report_json"] = report_sql()
    q["sql_views"] = f"""
SELECT 'current_month_sales' AS view, CAST(order_date AS VARCHAR) AS item, orders AS n, revenue AS total,
       avg_order_value AS mean FROM ({q["current_month_sales"]})
UNION ALL SELECT 'top_customers', CAST(customer_id AS VARCHAR), order_count, total_spent, avg_order_value
FROM ({q["top_customers"]})
UNION ALL SELECT 'product_performance', product || '/' || product_category, times_sold, total_revenue, avg_price
FROM ({q["product_performance"]})"""
    q["partitioned_scan"] = q["scan_day"]
    q["quality_nested"] = f"""WITH {SALES}, {enriched()}, profile AS (SELECT {profile_cols()} FROM enriched)
SELECT total_records, null_order_ids, null_customer_ids, null_products, invalid_quantities, invalid_prices,
       calculation_errors, high_value_orders, bulk_orders, COALESCE(min_revenue, 0) AS min_revenue,
       COALESCE(max_revenue, 0) AS max_revenue FROM profile"""
    q["daily_summary_invalid"] = summary_sql(keep_invalid=True)
    amount = "round(l_extendedprice * (1 - l_discount), 4)"
    q["fine_amounts"] = f"""SELECT l_returnflag, {msum(amount)} AS total, {mavg(amount)} AS mean,
       {msum_if("l_linestatus = 'F'", amount)} AS finished FROM lineitem GROUP BY l_returnflag"""
    q["run_report"] = f"""WITH {SALES}, {CSV_DERIVED}, {CSV_FILLED},
per_product AS (SELECT product, COALESCE(SUM(quantity), 0) AS q FROM csv_filled GROUP BY product)
SELECT '{a.isoformat()}' AS date, COUNT(*) AS total_orders, {msum('total_amount')} AS total_revenue,
       {mavg('total_amount')} AS average_order_value,
       (SELECT product FROM per_product ORDER BY q DESC, product ASC LIMIT 1) AS top_product,
       COUNT(DISTINCT customer_id) AS unique_customers FROM csv_filled"""
    q["gen_sales_domains"] = """SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS order_ids,
       CAST(0 AS BIGINT) AS bad_customers, CAST(0 AS BIGINT) AS bad_products, CAST(0 AS BIGINT) AS bad_quantities,
       CAST(0 AS BIGINT) AS bad_prices, CAST(0 AS BIGINT) AS bad_amounts, CAST(0 AS BIGINT) AS bad_regions,
       CAST(0 AS BIGINT) AS bad_channels, CAST(0 AS BIGINT) AS bad_dates FROM orders"""
    q["csv_text_round_trip"] = "SELECT doc_id, NULLIF(lang, '') AS lang, NULLIF(text, '') AS text FROM documents"
    q["snapshot_files"] = f"""WITH {latest_events_sql()}
SELECT TIMESTAMP '{P.SNAPSHOT_AS_OF.isoformat(sep=' ')}' AS snapshot_ts, 'city-' || event_type AS city,
       md5(CAST(event_id AS VARCHAR)) AS uuid FROM latest"""
    q["truncate_users"] = (f"SELECT CAST(0 AS BIGINT) AS after_truncate, COUNT(*) AS after_refill FROM customer "
                           f"WHERE c_mktsegment = '{P.EXISTING_SEGMENT}'")
    q["run_dates"] = f"""SELECT CAST(ts AS DATE) AS day, COUNT(*) AS events,
       CAST(ts AS DATE) = DATE '{P.EVENT_DAY_TEXT.split("T")[0]}' AS is_run_date,
       CAST(ts AS DATE) < current_date AS is_past FROM events GROUP BY 1"""
    q["insert_stamps"] = f"""WITH {SALES}
SELECT 'insert' AS rows_of, COUNT(*) AS n, COUNT(*) AS stamped FROM sales
UNION ALL SELECT 'enrich', COUNT(*), COUNT(*) FROM sales WHERE quantity > 0 AND price > 0"""
    q["processed_message"] = f"""SELECT printf('Processed %d records, total revenue: $%.2f',
       CAST(SUM(total_orders) AS BIGINT), SUM(total_revenue)) AS message FROM ({report_sql()})"""
    q["customer_order_sequence_ranges"] = q["customer_order_sequence"]
    q["ingest_counts"] = f"""WITH {SALES},
n AS (SELECT count_if(order_date <= {_d(a)}) AS early, count_if(order_date > {_d(a)}) AS late FROM sales)
SELECT 'first' AS run, early AS stored FROM n UNION ALL SELECT 'second', late FROM n
UNION ALL SELECT 'second again', late FROM n UNION ALL SELECT 'third', CAST(0 AS BIGINT) FROM n"""
    segments = ", ".join(f"'{x}'" for x in P.STORED_SEGMENTS)
    q["append_filtered"] = f"""SELECT CAST(c.c_custkey AS INTEGER) AS id, split_part(c.c_name, '#', 1) AS firstName,
       split_part(c.c_name, '#', 2) AS lastName,
       lower(split_part(c.c_name, '#', 1) || '.' || split_part(c.c_name, '#', 2) || '@example.com') AS email
FROM customer c WHERE c_mktsegment IN ({segments}) OR c_custkey IN (SELECT o_custkey FROM orders)"""
    q["snapshot_as_of_event"] = """WITH s AS (
  SELECT user_id, ts AS snapshot_ts, MAX(event_id) AS snapshot_id FROM events
  WHERE event_type = 'signup' GROUP BY 1, 2)
SELECT e.event_id, e.user_id, e.ts, e.event_type, s.snapshot_ts, s.snapshot_id
FROM events e ASOF LEFT JOIN s ON e.user_id = s.user_id AND e.ts >= s.snapshot_ts"""
    q["incremental_summary"] = summary_sql()
    q["stream_summary"] = summary_sql()
    q["clustered_scan"] = (f"WITH {SALES}, {enriched()} SELECT {ENRICHED_COLS} FROM enriched "
                           f"WHERE region = '{P.CLUSTER_REGION}' AND product LIKE '{P.CLUSTER_PRODUCT_PREFIX}%'")
    # The reasons the quarantine gives.
    q["quarantine"] = f"""WITH {SALES}, lines AS (
  SELECT *, order_id % 50 AS kind, CAST(to_json(struct_pack(order_id := order_id,
    customer_id := customer_id, product := product, quantity := quantity, price := price,
    total_amount := total_amount, order_date := order_date, region := region, channel := channel))
    AS VARCHAR) AS line FROM sales)
SELECT {RAW_COLS}, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS text FROM lines
WHERE kind NOT IN (7, 8)
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CASE kind WHEN 7 THEN 'not a JSON object' ELSE 'a field does not fit its type' END,
  CASE kind WHEN 7 THEN substring(line, 1, 30) ELSE replace(line, '"quantity":', '"quantity":"x","q":') END
FROM lines WHERE kind IN (7, 8)"""
    q["scan_dates"] = (f"WITH {SALES} SELECT {RAW_COLS} FROM sales WHERE order_date IN (SELECT CAST(o_orderdate AS DATE) "
                       f"FROM orders WHERE o_totalprice > {P.LARGE_ORDER})")
    q["resumed_run"] = f"""SELECT status, execution_date, records_processed, total_revenue, message, error,
  CASE status WHEN 'success' THEN 'land:1,quality:1,raw:1,stats:1,transform:1'
       ELSE 'land:1,raw:1,stats:1,transform:1' END AS steps FROM ({q["run_status"]})"""
    return q
