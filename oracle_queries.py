"""DuckDB oracle SQL for every registered query.

The oracle is written independently of the Spark code, directly from the
model definitions: the look-back is a brute-force correlated count of each
customer's earlier orders, the latest profile an ordered ``FIRST`` aggregate,
the forecast a recursive CTE, and so on. It runs on the test tables
registered as views (orders, lineitem, ...).

Output types are fixed on both sides: money and ratios as DOUBLE (money is
rounded to cents in DECIMAL first), counts as BIGINT, days as DATE.
"""

from __future__ import annotations

from basketry.config import DRIVER_CONFIG as CFG

Y0 = f"DATE '{CFG.year_start.isoformat()}'"
Y1 = f"DATE '{CFG.year_end.isoformat()}'"
Y_PREV = f"DATE '{CFG.two_year_start.isoformat()}'"
COMPLETE_FROM = f"DATE '{CFG.complete_history_from.isoformat()}'"
LOOKBACK = CFG.segmentation_lookback_months


def seg(expr: str) -> str:
    return (f"CASE WHEN {expr} <= {CFG.new_customer_max_prior_orders} THEN 'New' "
            f"WHEN {expr} BETWEEN {CFG.returning_min_prior_orders} AND {CFG.returning_max_prior_orders} THEN 'Returning' "
            f"WHEN {expr} >= {CFG.vip_min_prior_orders} THEN 'VIP' ELSE 'Unknown' END")


def money(expr: str) -> str:
    return f"CAST(CAST(ROUND({expr}, 2) AS DECIMAL(38,2)) AS DOUBLE)"


def xdiv(num: str, den: str) -> str:
    """num / den rounded half away from zero to cents, computed exactly on
    integers (DuckDB divides decimals in floating point, which misrounds
    exact half-cent ties). Result: DECIMAL with 2 digits, NULL for 0/NULL."""
    c = f"CAST(ROUND(({num}) * 1000000000) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(SIGN({c}) * SIGN({d}) * "
            f"((2 * ABS({c}) + ABS({d}) * 10000000) // (2 * ABS({d}) * 10000000)) AS DECIMAL(38,0)) * 0.01 END)")


BASE = f"""
raw_orders AS (
  SELECT o_orderdate AS date_date, o_custkey AS customers_id, o_orderkey AS orders_id,
         o_totalprice AS net_sales
  FROM orders),
raw_sales AS (
  SELECT o.o_orderdate AS date_date, o.o_custkey AS customer_id, l.l_orderkey AS order_id,
         l.l_partkey AS products_id,
         CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))), 2) AS DOUBLE) AS net_sales,
         l.l_quantity AS qty
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
stg_orders AS (
  SELECT TRY_CAST(date_date AS DATE) AS order_date, CAST(customers_id AS BIGINT) AS customer_id,
         CAST(orders_id AS BIGINT) AS order_id, CAST(net_sales AS DECIMAL(38,9)) AS net_sales
  FROM raw_orders),
stg_sales AS (
  SELECT TRY_CAST(date_date AS DATE) AS order_date, CAST(customer_id AS BIGINT) AS customer_id,
         CAST(order_id AS BIGINT) AS order_id, CAST(products_id AS BIGINT) AS product_id,
         CAST(net_sales AS DECIMAL(38,9)) AS line_net_sales, CAST(ROUND(qty) AS BIGINT) AS qty
  FROM raw_sales),
headed_lines AS (
  SELECT * FROM stg_sales WHERE order_id IN (SELECT order_id FROM stg_orders)),
int_order_product_summary AS (
  SELECT order_id, CAST(SUM(qty) AS BIGINT) AS qty_product, COUNT(*) AS product_line_count,
         COUNT(DISTINCT product_id) AS distinct_product_count
  FROM headed_lines GROUP BY order_id),
int_order_customer_history AS (
  -- brute force: count the earlier orders of the customer for every order
  SELECT o.order_id, o.customer_id, o.order_date, o.net_sales,
         (SELECT COUNT(e.order_id) FROM stg_orders e
           WHERE e.customer_id = o.customer_id
             AND e.order_date < o.order_date
             AND e.order_date >= CAST(o.order_date - INTERVAL {LOOKBACK} MONTH AS DATE)
         ) AS prior_orders_last_12_months,
         COALESCE(o.order_date >= {COMPLETE_FROM}, FALSE) AS has_complete_12_month_history
  FROM stg_orders o),
latest_profile AS (
  SELECT customer_id,
         FIRST({seg('prior_orders_last_12_months')}
               ORDER BY order_date DESC NULLS LAST, order_id DESC NULLS LAST) AS customer_profile
  FROM int_order_customer_history GROUP BY customer_id),
mart_orders AS (
  SELECT h.order_id, h.customer_id, h.order_date,
         CAST(EXTRACT(YEAR FROM h.order_date) AS BIGINT) AS order_year,
         CAST(EXTRACT(MONTH FROM h.order_date) AS BIGINT) AS order_month,
         CAST(DATE_TRUNC('month', h.order_date) AS DATE) AS order_month_start,
         h.net_sales,
         COALESCE(p.qty_product, 0) AS qty_product,
         COALESCE(p.product_line_count, 0) AS product_line_count,
         COALESCE(p.distinct_product_count, 0) AS distinct_product_count,
         h.prior_orders_last_12_months, h.has_complete_12_month_history,
         {seg('h.prior_orders_last_12_months')} AS order_segmentation,
         COALESCE(lp.customer_profile, {seg('h.prior_orders_last_12_months')}) AS customer_profile,
         CAST(1 AS BIGINT) AS order_count
  FROM int_order_customer_history h
  LEFT JOIN int_order_product_summary p ON h.order_id = p.order_id
  LEFT JOIN latest_profile lp ON h.customer_id = lp.customer_id),
mart_order_lines AS (
  SELECT s.order_id, s.customer_id, s.product_id, s.order_date,
         CAST(EXTRACT(YEAR FROM s.order_date) AS BIGINT) AS order_year,
         CAST(EXTRACT(MONTH FROM s.order_date) AS BIGINT) AS order_month,
         CAST(DATE_TRUNC('month', s.order_date) AS DATE) AS order_month_start,
         s.qty AS quantity, s.line_net_sales AS net_sales,
         oa.order_segmentation, oa.customer_profile,
         COALESCE(oa.has_complete_12_month_history, FALSE) AS has_complete_12_month_history,
         {xdiv('s.line_net_sales', 's.qty')} AS revenue_per_unit
  FROM headed_lines s
  LEFT JOIN mart_orders oa ON s.order_id = oa.order_id),
mart_product_summary AS (
  SELECT product_id,
         CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
         ROUND(SUM(net_sales), 2) AS total_product_revenue,
         COUNT(DISTINCT order_id) AS orders_containing_product,
         COUNT(DISTINCT customer_id) AS customers_buying_product,
         {xdiv('SUM(net_sales)', 'SUM(quantity)')} AS avg_revenue_per_unit,
         {xdiv('SUM(net_sales)', 'COUNT(DISTINCT order_id)')} AS avg_revenue_per_order,
         ROUND(SUM(CASE WHEN order_segmentation = 'New' THEN net_sales ELSE 0 END), 2) AS new_customer_revenue,
         ROUND(SUM(CASE WHEN order_segmentation = 'Returning' THEN net_sales ELSE 0 END), 2) AS returning_customer_revenue,
         ROUND(SUM(CASE WHEN order_segmentation = 'VIP' THEN net_sales ELSE 0 END), 2) AS vip_revenue,
         MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
         COUNT(DISTINCT DATE_TRUNC('month', order_date)) AS active_months,
         {xdiv('ROUND(SUM(net_sales), 2)', "COUNT(DISTINCT DATE_TRUNC('month', order_date))")} AS avg_monthly_revenue,
         ROUND(COUNT(DISTINCT order_id) / NULLIF(COUNT(DISTINCT DATE_TRUNC('month', order_date)), 0), 2)
           AS avg_monthly_orders
  FROM mart_order_lines GROUP BY product_id),
mart_orders_presentation AS (
  SELECT order_date, order_year, order_month, order_month_start, net_sales, qty_product,
         product_line_count, distinct_product_count, order_segmentation, customer_profile,
         has_complete_12_month_history, order_count,
         LOWER(SHA256(CAST(customer_id AS VARCHAR))) AS customer_ref
  FROM mart_orders),
mart_order_lines_presentation AS (
  SELECT product_id, order_date, order_year, order_month, order_month_start, order_segmentation,
         customer_profile, has_complete_12_month_history, quantity AS units_sold, net_sales,
         revenue_per_unit, CAST(1 AS BIGINT) AS order_line_count
  FROM mart_order_lines),
year_orders AS (
  SELECT * FROM mart_orders WHERE order_date >= {Y0} AND order_date < {Y1})
"""


def q(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body


ORACLE: dict[str, str] = {}

MART_ORDER_COLS = (
    "order_id, customer_id, order_date, order_year, order_month, order_month_start, "
    f"{money('net_sales')} AS net_sales, qty_product, product_line_count, distinct_product_count, "
    "prior_orders_last_12_months, has_complete_12_month_history, order_segmentation, customer_profile, "
    "order_count")


def pct(part: str, whole: str, digits: int = 1) -> str:
    return f"ROUND(CAST({part} AS DOUBLE) * 100.0 / NULLIF(CAST({whole} AS DOUBLE), 0), {digits})"


SEG_IN = "('New', 'Returning', 'VIP')"
Y_EXTRA = f"""
, exercise_6 AS (
  SELECT order_id, customer_id, order_date, net_sales, qty_product, order_segmentation
  FROM mart_orders WHERE order_date >= {Y0} AND order_date < {Y1})
"""

ORACLE.update({
    # sources
    "raw_orders_profile": q("""
SELECT COUNT(*) AS row_count, CAST(4 AS BIGINT) AS column_count,
       MIN(date_date) AS min_date, MAX(date_date) AS max_date
FROM raw_orders"""),
    "raw_orders_null_counts": q("""
SELECT COUNT(*) FILTER (WHERE date_date IS NULL) AS date_date,
       COUNT(*) FILTER (WHERE customers_id IS NULL) AS customers_id,
       COUNT(*) FILTER (WHERE orders_id IS NULL) AS orders_id,
       COUNT(*) FILTER (WHERE net_sales IS NULL) AS net_sales
FROM raw_orders"""),
    # staging / intermediate / marts
    "stg_orders": q(f"SELECT order_date, customer_id, order_id, {money('net_sales')} AS net_sales FROM stg_orders"),
    "stg_sales": q(f"""
SELECT order_date, customer_id, order_id, product_id, {money('line_net_sales')} AS line_net_sales, qty
FROM stg_sales"""),
    "int_order_product_summary": q("SELECT * FROM int_order_product_summary"),
    "int_order_customer_history": q(f"""
SELECT order_id, customer_id, order_date, {money('net_sales')} AS net_sales, prior_orders_last_12_months,
       has_complete_12_month_history
FROM int_order_customer_history"""),
    "mart_orders": q(f"SELECT {MART_ORDER_COLS} FROM mart_orders"),
    "mart_order_lines": q(f"""
SELECT order_id, customer_id, product_id, order_date, order_year, order_month, order_month_start, quantity,
       {money('net_sales')} AS net_sales, order_segmentation, customer_profile, has_complete_12_month_history,
       {money('revenue_per_unit')} AS revenue_per_unit
FROM mart_order_lines"""),
    "mart_product_summary": q(f"""
SELECT product_id, total_units_sold, {money('total_product_revenue')} AS total_product_revenue,
       orders_containing_product, customers_buying_product,
       {money('avg_revenue_per_unit')} AS avg_revenue_per_unit,
       {money('avg_revenue_per_order')} AS avg_revenue_per_order,
       {money('new_customer_revenue')} AS new_customer_revenue,
       {money('returning_customer_revenue')} AS returning_customer_revenue,
       {money('vip_revenue')} AS vip_revenue, first_order_date, last_order_date, active_months,
       {money('avg_monthly_revenue')} AS avg_monthly_revenue, avg_monthly_orders
FROM mart_product_summary"""),
    "mart_orders_presentation": q(f"""
SELECT order_date, order_year, order_month, order_month_start, {money('net_sales')} AS net_sales, qty_product,
       product_line_count, distinct_product_count, order_segmentation, customer_profile,
       has_complete_12_month_history, order_count, customer_ref
FROM mart_orders_presentation"""),
    "mart_order_lines_presentation": q(f"""
SELECT product_id, order_date, order_year, order_month, order_month_start, order_segmentation,
       customer_profile, has_complete_12_month_history, units_sold, {money('net_sales')} AS net_sales,
       {money('revenue_per_unit')} AS revenue_per_unit, order_line_count
FROM mart_order_lines_presentation"""),
    "exercise_4_orders_with_qty": q(f"""
SELECT order_id, customer_id, order_date, {money('net_sales')} AS net_sales, qty_product
FROM mart_orders WHERE order_date >= {Y_PREV} AND order_date < {Y1}"""),
    "exercise_6_orders_segmented": q(f"""
SELECT order_id, customer_id, order_date, {money('net_sales')} AS net_sales, qty_product, order_segmentation
FROM year_orders"""),
    # exercises
    "ex1_orders_in_year": q("SELECT COUNT(*) AS nb_orders FROM year_orders"),
    "ex2_orders_per_month": q("""
SELECT CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_month, COUNT(*) AS nb_orders
FROM year_orders GROUP BY 1 ORDER BY 1"""),
    "ex3_avg_qty_per_month": q("""
SELECT CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_month,
       ROUND(AVG(qty_product), 2) AS avg_qty_products_per_order
FROM year_orders GROUP BY 1 ORDER BY 1"""),
    # insights
    "monthly_pattern": q(f"""
SELECT STRFTIME(order_date, '%b') AS month_name, CAST(EXTRACT(MONTH FROM order_date) AS BIGINT) AS month_num,
       COUNT(*) AS orders, CAST(SUM(qty_product) AS BIGINT) AS total_qty,
       ROUND(CAST(SUM(qty_product) AS DOUBLE) / COUNT(*), 2) AS avg_products_per_order,
       {money('SUM(net_sales)')} AS total_revenue
FROM year_orders GROUP BY 1, 2 ORDER BY 2"""),
    "quarter_share": q(f"""
SELECT COUNT(*) FILTER (WHERE QUARTER(order_date) = 4) AS quarter_orders,
       {pct('COUNT(*) FILTER (WHERE QUARTER(order_date) = 4)', 'COUNT(*)')} AS pct_of_year
FROM year_orders"""),
    "peak_month_ratio": q("""
, monthly AS (SELECT CAST(EXTRACT(MONTH FROM order_date) AS BIGINT) AS m, COUNT(*) AS cnt
              FROM year_orders GROUP BY 1),
hi AS (SELECT m, cnt FROM monthly ORDER BY cnt DESC, m ASC LIMIT 1),
lo AS (SELECT m, cnt FROM monthly ORDER BY cnt ASC, m ASC LIMIT 1)
SELECT hi.cnt AS max_orders, lo.cnt AS min_orders, hi.m AS max_month, lo.m AS min_month,
       ROUND(CAST(hi.cnt AS DOUBLE) / lo.cnt, 2) AS max_min_ratio
FROM hi, lo"""),
    "segment_breakdown": q(f"""
SELECT order_segmentation, COUNT(*) AS orders, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct,
       {money('SUM(net_sales)')} AS revenue
FROM year_orders GROUP BY 1 ORDER BY 2 DESC"""),
    "returning_vip_share": q(f"""
SELECT COUNT(*) FILTER (WHERE order_segmentation IN ('Returning', 'VIP')) AS orders,
       {pct("COUNT(*) FILTER (WHERE order_segmentation IN ('Returning', 'VIP'))", 'COUNT(*)')} AS pct
FROM year_orders"""),
    "overall_stats": q(f"""
SELECT COUNT(*) AS total_orders,
       COUNT(*) FILTER (WHERE order_date >= {Y0} AND order_date < {Y1}) AS orders_report_year,
       COUNT(*) FILTER (WHERE order_date >= {Y_PREV} AND order_date < {Y0}) AS orders_previous_year,
       {money('SUM(net_sales)')} AS total_revenue,
       {money(xdiv('SUM(net_sales)', 'COUNT(*)'))} AS aov,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM mart_orders"""),
    # ids that only lines have, and their lines
    "orphan_line_count": q("""
, headerless AS (SELECT order_id FROM stg_sales EXCEPT SELECT order_id FROM stg_orders)
SELECT (SELECT COUNT(*) FROM stg_sales WHERE order_id IN (SELECT order_id FROM headerless))
       + (SELECT COUNT(*) FROM stg_sales WHERE order_id IS NULL) AS orphan_lines"""),
    # every order with the number of orders on its customer's day
    "same_day_collisions": q("""
, with_day AS (SELECT customer_id, order_date,
                      COUNT(*) OVER (PARTITION BY customer_id, order_date) AS on_day,
                      ROW_NUMBER() OVER (PARTITION BY customer_id, order_date) AS nth
               FROM mart_orders)
SELECT COUNT(*) FILTER (WHERE on_day > 1 AND nth = 1) AS affected_groups,
       COUNT(DISTINCT CASE WHEN on_day > 1 THEN customer_id END) AS affected_customers,
       COUNT(*) FILTER (WHERE on_day > 1) AS affected_rows
FROM with_day"""),
    "history_completeness": q("""
SELECT COUNT(*) FILTER (WHERE has_complete_12_month_history) AS full_history,
       COUNT(*) FILTER (WHERE NOT has_complete_12_month_history) AS partial_history,
       COUNT(*) AS total
FROM mart_orders"""),
    # one union of signed amounts: orders count up, lines down
    "revenue_reconciliation": q(f"""
, amounts AS (SELECT net_sales AS amount, 1 AS side FROM mart_orders
              UNION ALL SELECT net_sales, -1 FROM mart_order_lines)
SELECT {money('SUM(amount) FILTER (WHERE side = 1)')} AS order_total,
       {money('SUM(amount) FILTER (WHERE side = -1)')} AS sales_total,
       {money('ABS(SUM(amount * side))')} AS difference
FROM amounts"""),
    "data_summary": q(f"""
, h AS (SELECT COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS unique_customers FROM stg_orders),
r AS (SELECT COUNT(*) AS sales_lines, CAST(SUM(qty) AS BIGINT) AS units_raw, SUM(line_net_sales) AS revenue_raw,
             COUNT(DISTINCT product_id) AS unique_products, COUNT(DISTINCT order_id) AS orders_with_lines_raw
      FROM stg_sales),
m AS (SELECT COUNT(*) AS mart_lines, CAST(SUM(quantity) AS BIGINT) AS units_mart, SUM(net_sales) AS revenue_mart
      FROM mart_order_lines),
o AS (SELECT COUNT(*) AS orphan_lines FROM stg_sales s LEFT JOIN stg_orders x ON s.order_id = x.order_id
      WHERE x.order_id IS NULL),
g AS (SELECT customer_id, order_date, COUNT(*) AS cnt FROM mart_orders GROUP BY 1, 2 HAVING COUNT(*) > 1),
sd AS (SELECT COUNT(*) AS affected_groups, COUNT(DISTINCT customer_id) AS affected_customers,
              CAST(COALESCE(SUM(cnt), 0) AS BIGINT) AS affected_rows FROM g)
SELECT orders, unique_customers, sales_lines, units_raw, {money('revenue_raw')} AS revenue_raw, unique_products,
       orders_with_lines_raw, mart_lines, units_mart, {money('revenue_mart')} AS revenue_mart, orphan_lines,
       affected_groups, affected_customers, affected_rows,
       {money('revenue_raw - revenue_mart')} AS revenue_excluded
FROM h, r, m, o, sd"""),
    "freshness": q("SELECT MAX(order_date) AS max_order_date FROM mart_orders"),
    # dashboard
    "kpi_tiles": q(f"""
SELECT {money('SUM(net_sales)')} AS net_sales, CAST(SUM(order_count) AS BIGINT) AS orders,
       {money(xdiv('SUM(net_sales)', 'SUM(order_count)'))} AS average_order_value,
       CAST(SUM(qty_product) AS BIGINT) AS products_sold,
       ROUND(CAST(SUM(qty_product) AS DOUBLE) / SUM(order_count), 2) AS products_per_order,
       COUNT(DISTINCT customer_ref) AS unique_customers
FROM mart_orders_presentation"""),
    "daily_trends": q(f"""
SELECT order_date, {money('SUM(net_sales)')} AS net_sales, COUNT(*) AS orders,
       {money(xdiv('SUM(net_sales)', 'COUNT(*)'))} AS average_order_value
FROM mart_orders GROUP BY order_date"""),
    "month_contribution": q(f"""
, r AS (SELECT order_year, order_half, order_month, SUM(net_sales) AS revenue, COUNT(*) AS orders,
               GROUPING(order_year, order_half, order_month) AS gid
        FROM (SELECT *, CAST(CASE WHEN order_month <= 6 THEN 1 ELSE 2 END AS BIGINT) AS order_half
              FROM mart_orders)
        GROUP BY ROLLUP (order_year, order_half, order_month)),
t AS (SELECT revenue AS tot_rev, orders AS tot_ord FROM r WHERE gid = 7)
SELECT CASE gid WHEN 0 THEN 'month' WHEN 1 THEN 'half' WHEN 3 THEN 'year' ELSE 'total' END AS level,
       order_year, order_half, order_month,
       {money('revenue')} AS revenue, {pct('revenue', 'tot_rev')} AS revenue_pct,
       orders, {pct('orders', 'tot_ord')} AS orders_pct
FROM r, t"""),
    "quarter_summary": q(f"""
, g AS (SELECT order_year, CAST(QUARTER(order_date) AS BIGINT) AS order_quarter, SUM(net_sales) AS revenue,
               COUNT(*) AS orders FROM mart_orders GROUP BY 1, 2)
SELECT order_year, order_quarter, {money('revenue')} AS revenue,
       {pct('revenue', 'SUM(revenue) OVER ()')} AS revenue_pct, orders,
       {pct('orders', 'SUM(orders) OVER ()')} AS orders_pct
FROM g"""),
    "sales_by_order_segment": q(f"""
SELECT order_segmentation, {money('SUM(net_sales)')} AS net_sales, COUNT(*) AS orders
FROM mart_orders GROUP BY 1"""),
    "sales_by_customer_profile": q(f"""
SELECT customer_profile, {money('SUM(net_sales)')} AS net_sales, COUNT(*) AS orders
FROM mart_orders GROUP BY 1"""),
    "segment_table": q(f"""
SELECT order_segmentation, COUNT(*) AS orders, {money('SUM(net_sales)')} AS net_sales,
       {money(xdiv('SUM(net_sales)', 'COUNT(*)'))} AS average_order_value,
       ROUND(CAST(SUM(qty_product) AS DOUBLE) / COUNT(*), 2) AS avg_products_per_order
FROM mart_orders GROUP BY 1"""),
    "top_products_by_revenue": q(f"""
SELECT product_id, {money('total_product_revenue')} AS revenue, total_units_sold AS units,
       orders_containing_product AS orders, customers_buying_product AS customers
FROM mart_product_summary ORDER BY total_product_revenue DESC, product_id ASC LIMIT {CFG.top_n}"""),
    "top_products_by_units": q(f"""
SELECT product_id, {money('total_product_revenue')} AS revenue, total_units_sold AS units,
       orders_containing_product AS orders, customers_buying_product AS customers
FROM mart_product_summary ORDER BY total_units_sold DESC, product_id ASC LIMIT {CFG.top_n}"""),
    "revenue_by_product": q(f"""
SELECT product_id, {money('SUM(net_sales)')} AS revenue, CAST(SUM(units_sold) AS BIGINT) AS units,
       CAST(SUM(order_line_count) AS BIGINT) AS order_lines
FROM mart_order_lines_presentation GROUP BY product_id"""),
    "units_histogram": q(f"""
, p AS (SELECT product_id, SUM(units_sold) AS units FROM mart_order_lines_presentation GROUP BY 1),
b AS (SELECT CAST(FLOOR(units / {CFG.histogram_bucket_width}.0) * {CFG.histogram_bucket_width} AS BIGINT) AS bucket_start
      FROM p)
SELECT bucket_start, bucket_start + {CFG.histogram_bucket_width} AS bucket_end, COUNT(*) AS products
FROM b GROUP BY bucket_start"""),
    "segment_share_in_year": q(f"""
, g AS (SELECT order_segmentation, COUNT(*) AS orders, SUM(net_sales) AS revenue FROM year_orders GROUP BY 1)
SELECT order_segmentation, orders, {pct('orders', 'SUM(orders) OVER ()')} AS orders_pct,
       {money('revenue')} AS revenue, {pct('revenue', 'SUM(revenue) OVER ()')} AS revenue_pct
FROM g"""),
    "q4_revenue_share": q(f"""
SELECT {money('SUM(CASE WHEN QUARTER(order_date) = 4 THEN net_sales ELSE 0 END)')} AS quarter_revenue,
       {money('SUM(net_sales)')} AS total_revenue,
       {pct('SUM(CASE WHEN QUARTER(order_date) = 4 THEN net_sales ELSE 0 END)', 'SUM(net_sales)')} AS revenue_pct
FROM mart_orders"""),
})

# -- data quality ------------------------------------------------------------------

_REL = {
    "raw_orders": "raw_orders", "raw_sales": "raw_sales", "stg_orders": "stg_orders", "stg_sales": "stg_sales",
    "order_product_summary": "int_order_product_summary",
    "order_customer_history": "int_order_customer_history", "mart_orders": "mart_orders",
    "mart_orders_presentation": "mart_orders_presentation", "exercise_6": "exercise_6",
    "mart_order_lines": "mart_order_lines", "mart_order_lines_presentation": "mart_order_lines_presentation",
    "mart_product_summary": "mart_product_summary",
}

SINGULAR = {
    "invalid_segments": f"SELECT {MART_ORDER_COLS} FROM mart_orders "
                        f"WHERE order_segmentation NOT IN {SEG_IN} OR order_segmentation IS NULL",
    "order_lines_grain": "SELECT order_id, product_id, COUNT(*) AS row_count FROM mart_order_lines "
                         "GROUP BY order_id, product_id HAVING COUNT(*) > 1",
    "order_sales_match": f"""SELECT o.order_id, {money('o.net_sales')} AS net_sales,
       {money('l.line_net_sales')} AS line_net_sales
FROM stg_orders o
LEFT JOIN (SELECT order_id, SUM(line_net_sales) AS line_net_sales FROM stg_sales GROUP BY order_id) l
  ON o.order_id = l.order_id
WHERE ABS(COALESCE(o.net_sales, 0) - COALESCE(l.line_net_sales, -1)) > 0.01""",
    "positive_product_qty": f"SELECT {MART_ORDER_COLS} FROM mart_orders WHERE qty_product <= 0 OR qty_product IS NULL",
    "lines_have_header": "SELECT s.order_id FROM stg_sales s LEFT JOIN stg_orders o ON s.order_id = o.order_id "
                         "WHERE o.order_id IS NULL",
    "segmentation_reconciliation": f"""SELECT order_id, derived_segment, stored_segment FROM (
  SELECT order_id, {seg('prior_orders_last_12_months')} AS derived_segment, order_segmentation AS stored_segment
  FROM mart_orders) WHERE derived_segment IS DISTINCT FROM stored_segment""",
    "profile_reconciliation": """SELECT m.order_id, m.customer_id, m.customer_profile AS stored_profile,
       COALESCE(lp.seg, m.order_segmentation) AS derived_profile
FROM mart_orders m
LEFT JOIN (SELECT customer_id, order_segmentation AS seg FROM mart_orders WHERE customer_id IS NOT NULL
           QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id
                                      ORDER BY order_date DESC NULLS LAST, order_id DESC NULLS LAST) = 1) lp
  ON m.customer_id = lp.customer_id
WHERE m.customer_profile IS DISTINCT FROM COALESCE(lp.seg, m.order_segmentation)""",
    "year_count_match": f"""SELECT mart_count, source_count FROM
  (SELECT COUNT(*) AS mart_count FROM year_orders),
  (SELECT COUNT(*) AS source_count FROM stg_orders WHERE order_date >= {Y0} AND order_date < {Y1})
WHERE mart_count <> source_count""",
    "segmented_year_count_match": f"""SELECT segmented_count, source_count FROM
  (SELECT COUNT(*) AS segmented_count FROM exercise_6),
  (SELECT COUNT(*) AS source_count FROM stg_orders WHERE EXTRACT(YEAR FROM order_date) = {CFG.report_year})
WHERE segmented_count <> source_count""",
    "monthly_count_match": f"""SELECT COALESCE(m.month_num, s.month_num) AS month_num, m.mart_count, s.source_count
FROM (SELECT CAST(EXTRACT(MONTH FROM order_date) AS BIGINT) AS month_num, COUNT(*) AS mart_count
      FROM year_orders GROUP BY 1) m
FULL OUTER JOIN (SELECT CAST(EXTRACT(MONTH FROM order_date) AS BIGINT) AS month_num, COUNT(*) AS source_count
      FROM stg_orders WHERE order_date >= {Y0} AND order_date < {Y1} GROUP BY 1) s
  ON m.month_num = s.month_num
WHERE m.mart_count IS DISTINCT FROM s.source_count""",
    "order_grain_in_year": "SELECT order_id FROM year_orders GROUP BY order_id HAVING COUNT(*) > 1",
}
_SINGULAR_SEVERITY = {"lines_have_header": "warn"}


# The declared checks, stated here on their own (fixed list of the documented contracts).
DECLARED_NOT_NULL = """
raw_orders: orders_id customers_id date_date
raw_sales: order_id products_id qty
stg_orders: order_id customer_id order_date
stg_sales: order_id product_id qty
order_product_summary: order_id qty_product
order_customer_history: order_id customer_id order_date prior_orders_last_12_months
mart_orders: order_id customer_id order_date net_sales order_segmentation customer_profile
mart_orders_presentation: order_date net_sales
exercise_6: order_segmentation
mart_order_lines: order_id customer_id product_id order_date quantity net_sales order_segmentation customer_profile
mart_order_lines_presentation: product_id order_date units_sold net_sales order_segmentation customer_profile
mart_product_summary: product_id
"""
DECLARED_UNIQUE = """raw_orders.orders_id stg_orders.order_id order_product_summary.order_id
order_customer_history.order_id mart_orders.order_id mart_product_summary.product_id"""
DECLARED_ACCEPTED = """mart_orders.order_segmentation mart_orders.customer_profile exercise_6.order_segmentation
mart_order_lines.order_segmentation mart_order_lines.customer_profile"""


def _check_summary_sql() -> str:
    NOT_NULL = {rel: cols.split() for rel, cols in (x.split(": ") for x in DECLARED_NOT_NULL.strip().splitlines())}
    UNIQUE = [tuple(x.split(".")) for x in DECLARED_UNIQUE.split()]
    ACCEPTED = [tuple(x.split(".")) for x in DECLARED_ACCEPTED.split()]
    parts = []
    for rel, cols in NOT_NULL.items():
        for c in cols:
            parts.append(f"SELECT 'not_null:{rel}.{c}' AS check_name, 'error' AS severity, COUNT(*) AS failures "
                         f"FROM {_REL[rel]} WHERE {c} IS NULL")
    for rel, c in UNIQUE:
        parts.append(f"SELECT 'unique:{rel}.{c}', 'error', COUNT(*) FROM (SELECT {c} FROM {_REL[rel]} "
                     f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
    for rel, c in ACCEPTED:
        parts.append(f"SELECT 'accepted_values:{rel}.{c}', 'error', COUNT(*) FROM {_REL[rel]} "
                     f"WHERE {c} NOT IN {SEG_IN}")
    parts.append("SELECT 'relationships:stg_sales.order_id', 'warn', COUNT(*) FROM stg_sales c "
                 "LEFT JOIN stg_orders p ON c.order_id = p.order_id "
                 "WHERE c.order_id IS NOT NULL AND p.order_id IS NULL")
    for name, sql in SINGULAR.items():
        if name == "profile_reconciliation":  # extra check, not one of the declared 64
            continue
        parts.append(f"SELECT '{name}', '{_SINGULAR_SEVERITY.get(name, 'error')}', COUNT(*) FROM ({sql})")
    return q(Y_EXTRA + "\n" + "\nUNION ALL\n".join(parts))


ORACLE["dq_check_summary"] = _check_summary_sql()
for _name, _key in [("dq_invalid_segments", "invalid_segments"), ("dq_order_lines_grain", "order_lines_grain"),
                    ("dq_order_sales_match", "order_sales_match"),
                    ("dq_positive_product_qty", "positive_product_qty"),
                    ("dq_lines_without_header", "lines_have_header"),
                    ("dq_segmentation_reconciliation", "segmentation_reconciliation"),
                    ("dq_profile_reconciliation", "profile_reconciliation"),
                    ("dq_year_count_match", "year_count_match"),
                    ("dq_segmented_year_count_match", "segmented_year_count_match"),
                    ("dq_monthly_count_match", "monthly_count_match"),
                    ("dq_order_grain_in_year", "order_grain_in_year")]:
    ORACLE[_name] = q(Y_EXTRA + "\n" + SINGULAR[_key])

# -- metric layer -------------------------------------------------------------------

_ORDER_MEASURES_SQL = f"""COUNT(*) AS order_count, {money('SUM(net_sales)')} AS total_net_sales,
       {money(xdiv('SUM(net_sales)', 'COUNT(net_sales)'))} AS average_order_value, CAST(SUM(qty_product) AS BIGINT) AS total_products,
       AVG(qty_product) AS average_products_per_order, COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(*) FILTER (WHERE order_segmentation = 'New') AS new_customer_orders,
       COUNT(*) FILTER (WHERE order_segmentation = 'Returning') AS returning_customer_orders,
       COUNT(*) FILTER (WHERE order_segmentation = 'VIP') AS vip_orders,
       {money("SUM(CASE WHEN order_segmentation = 'New' THEN net_sales ELSE 0 END)")} AS new_customer_revenue,
       {money("SUM(CASE WHEN order_segmentation = 'Returning' THEN net_sales ELSE 0 END)")} AS returning_customer_revenue,
       {money("SUM(CASE WHEN order_segmentation = 'VIP' THEN net_sales ELSE 0 END)")} AS vip_revenue"""

SUNDAY_WEEK = "CAST(order_date - CAST(DAYOFWEEK(order_date) AS INTEGER) AS DATE)"

ORACLE.update({
    "metrics_orders_by_month": q(f"""
SELECT CAST(CAST(DATE_TRUNC('month', order_date) AS DATE) AS VARCHAR) AS order_date_at_selected_grain,
       {_ORDER_MEASURES_SQL}
FROM mart_orders GROUP BY 1"""),
    "metrics_orders_by_week": q(f"""
SELECT CAST({SUNDAY_WEEK} AS VARCHAR) AS order_date_at_selected_grain, COUNT(*) AS order_count,
       {money('SUM(net_sales)')} AS total_net_sales, COUNT(DISTINCT customer_id) AS unique_customers
FROM mart_orders GROUP BY 1"""),
    "metrics_orders_by_segment_profile": q(f"""
SELECT order_segmentation, customer_profile, COUNT(*) AS order_count, {money('SUM(net_sales)')} AS total_net_sales,
       {money(xdiv('SUM(net_sales)', 'COUNT(net_sales)'))} AS average_order_value, AVG(qty_product) AS average_products_per_order,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM mart_orders GROUP BY 1, 2"""),
    "metrics_lines_by_product": q(f"""
SELECT product_id, {money('SUM(net_sales)')} AS total_net_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(DISTINCT product_id) AS unique_products,
       {money(xdiv('SUM(net_sales)', 'SUM(quantity)'))} AS average_revenue_per_unit,
       CAST(SUM(quantity) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0) AS average_quantity_per_order,
       {money("SUM(CASE WHEN order_segmentation = 'New' THEN net_sales ELSE 0 END)")} AS new_customer_revenue,
       {money("SUM(CASE WHEN order_segmentation = 'Returning' THEN net_sales ELSE 0 END)")} AS returning_customer_revenue,
       {money("SUM(CASE WHEN order_segmentation = 'VIP' THEN net_sales ELSE 0 END)")} AS vip_revenue
FROM mart_order_lines GROUP BY product_id"""),
    "metrics_lines_by_quarter_segment": q(f"""
SELECT CAST(DATE_TRUNC('quarter', order_date) AS DATE) AS order_date_quarter, order_segmentation,
       {money('SUM(net_sales)')} AS total_net_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT product_id) AS unique_products
FROM mart_order_lines GROUP BY 1, 2"""),
    "metrics_vip_revenue_by_quarter": q(f"""
SELECT CAST(CAST(DATE_TRUNC('quarter', order_date) AS DATE) AS VARCHAR) AS order_date_at_selected_grain,
       {money('SUM(net_sales)')} AS total_net_sales
FROM mart_orders WHERE order_segmentation = 'VIP' GROUP BY 1"""),
})

# -- time series ---------------------------------------------------------------------

ORACLE.update({
    "daily_sales_zero_filled": q(f"""
, bounds AS (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM mart_orders),
spine AS (SELECT CAST(d AS DATE) AS date FROM bounds, RANGE(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
daily AS (SELECT order_date, SUM(net_sales) AS v FROM mart_orders GROUP BY order_date)
SELECT s.date, {money('COALESCE(d.v, 0)')} AS daily_net_sales
FROM spine s LEFT JOIN daily d ON s.date = d.order_date"""),
    "daily_sales_actuals": q(f"""
SELECT order_date AS date, {money('SUM(net_sales)')} AS daily_net_sales FROM mart_orders GROUP BY order_date"""),
    "days_without_orders": q("""
, bounds AS (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM mart_orders),
spine AS (SELECT CAST(d AS DATE) AS date FROM bounds, RANGE(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d))
SELECT date FROM spine WHERE date NOT IN (SELECT order_date FROM mart_orders WHERE order_date IS NOT NULL)"""),
    "forecast_row_counts": q("""
SELECT 'Actual' AS series_type, CAST(NULL AS BIGINT) AS horizon, COUNT(*) AS row_count
FROM (SELECT order_date FROM mart_orders GROUP BY order_date)
UNION ALL
SELECT 'Forecast', CAST(h AS BIGINT), CAST(h AS BIGINT) FROM (VALUES (7), (14), (30)) t(h)
ORDER BY 1, 2"""),
})

# -- forecast ------------------------------------------------------------------------
# Same model as the Spark code, written as a recursive CTE: weekday index from
# exact decimal sums, exponential smoothing for every weight of the grid, the
# weight with the least squared one-step error (ties: smaller weight).

Z95 = "CAST(1.959964 AS DOUBLE)"


def qr(body: str) -> str:
    return "WITH RECURSIVE " + BASE.strip() + "\n" + body


def _k(keys, prefix=""):
    return "".join(f"{prefix}{k}, " for k in keys)


def _on(keys, a, b, extra):
    conds = [f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys] + [extra]
    return " AND ".join(conds)


def _part(keys):
    return f"PARTITION BY {', '.join(keys)}" if keys else ""


def _fc_ctes(keys, holdouts=None, horizon=30, source="mart_orders") -> str:
    """CTEs: ser (zero-filled cents), tr (training rows), ix, pts, rec, model, steps.
    With ``holdouts`` the series are (keys, holdout_days) and training stops
    h days before each key's last day."""
    k = list(keys)
    gb_keys = ", ".join(k)
    d0 = (f"d0 AS (SELECT {_k(k)}order_date AS date, SUM(net_sales) AS v FROM {source} "
          f"WHERE order_date IS NOT NULL GROUP BY {_k(k)}order_date)")
    b0 = (f"b0 AS (SELECT {_k(k)}MIN(date) AS lo, MAX(date) AS hi FROM d0"
          + (f" GROUP BY {gb_keys})" if k else ")"))
    sp = (f"sp AS (SELECT {_k(k)}CAST(UNNEST(GENERATE_SERIES(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b0)")
    ser = (f"ser AS (SELECT {_k(k, 'sp.')}sp.date, CAST(ROUND(COALESCE(d0.v, 0), 2) AS DECIMAL(38,2)) AS v "
           f"FROM sp LEFT JOIN d0 ON {_on(k, 'sp', 'd0', 'sp.date = d0.date')})")
    if holdouts:
        hs = ", ".join(f"({h})" for h in holdouts)
        kk = k + ["holdout_days"]
        tag = (f"tag AS (SELECT ser.*, CAST(h.h AS BIGINT) AS holdout_days, "
               f"MAX(ser.date) OVER ({_part(k)}) AS last_date_all FROM ser, (VALUES {hs}) h(h))")
        tr = (f"tr AS (SELECT {_k(kk)}date, v FROM tag "
              f"WHERE date <= CAST(last_date_all - CAST(holdout_days AS INTEGER) AS DATE))")
        pre = [d0, b0, sp, ser, tag, tr]
    else:
        kk = k
        pre = [d0, b0, sp, ser, "tr AS (SELECT * FROM ser)"]
    gk = ", ".join(kk)
    bd = (f"bd AS (SELECT {_k(kk)}DAYOFWEEK(date) + 1 AS dow, SUM(v) AS s, COUNT(*) AS n FROM tr "
          f"GROUP BY {_k(kk)}DAYOFWEEK(date) + 1)")
    ix = (f"ix AS (SELECT {_k(kk)}dow, CAST(s AS DOUBLE) / n - CAST(SUM(s) OVER ({_part(kk)}) AS DOUBLE) "
          f"/ SUM(n) OVER ({_part(kk)}) AS dow_index FROM bd)")
    des = (f"des AS (SELECT {_k(kk, 'tr.')}tr.date, CAST(tr.v AS DOUBLE) - ix.dow_index AS y FROM tr "
           f"JOIN ix ON {_on(kk, 'tr', 'ix', 'DAYOFWEEK(tr.date) + 1 = ix.dow')})")
    pts = (f"pts AS (SELECT {_k(kk)}date, y, ROW_NUMBER() OVER ({_part(kk)} ORDER BY date) AS i, "
           f"COUNT(*) OVER ({_part(kk)}) AS n, MAX(date) OVER ({_part(kk)}) AS last_date FROM des)")
    grid = "grid AS (SELECT CAST(g AS DOUBLE) / 100 AS a FROM range(1, 100) t(g))"
    rec = (f"rec AS (SELECT {_k(kk, 'p.')}g.a, p.i, p.n, p.last_date, p.y AS level, CAST(0 AS DOUBLE) AS sse "
           f"FROM pts p, grid g WHERE p.i = 1 "
           f"UNION ALL SELECT {_k(kk, 'r.')}r.a, p.i, r.n, r.last_date, r.a * p.y + (1 - r.a) * r.level, "
           f"r.sse + (p.y - r.level) * (p.y - r.level) FROM rec r JOIN pts p ON "
           f"{_on(kk, 'p', 'r', 'p.i = r.i + 1')})")
    model = (f"model AS (SELECT {_k(kk)}last_date, n, a AS alpha, level, sse, "
             f"CASE WHEN n > 1 THEN SQRT(sse / (n - 1)) END AS sigma FROM rec WHERE i = n "
             f"QUALIFY ROW_NUMBER() OVER ({_part(kk)} ORDER BY sse, a) = 1)")
    steps = (f"steps AS (SELECT {_k(kk, 'm.')}CAST(m.last_date + CAST(t.s AS INTEGER) AS DATE) AS date, "
             f"CAST(t.s AS BIGINT) AS step, m.alpha, m.sigma, "
             f"m.level + COALESCE(ix.dow_index, 0.0) AS fv FROM model m CROSS JOIN range(1, {horizon + 1}) t(s) "
             f"LEFT JOIN ix ON {_on(kk, 'm', 'ix', 'DAYOFWEEK(m.last_date + CAST(t.s AS INTEGER)) + 1 = ix.dow')})")
    band = (f"band AS (SELECT *, {Z95} * sigma * SQRT(1.0 + (step - 1) * alpha * alpha) AS hw FROM steps)")
    return ", " + ",\n".join(pre + [bd, ix, des, pts, grid, rec, model, steps, band])


def _actuals(keys, with_h, source="mart_orders"):
    h = ", CAST(NULL AS BIGINT) AS horizon" if with_h else ""
    return (f"SELECT {_k(keys)}order_date AS date, "
            f"ROUND(CAST(CAST(ROUND(SUM(net_sales), 2) AS DECIMAL(38,2)) AS DOUBLE), 2) AS daily_net_sales, "
            f"CAST(NULL AS DOUBLE) AS forecast_value, CAST(NULL AS DOUBLE) AS confidence_lower, "
            f"CAST(NULL AS DOUBLE) AS confidence_upper, 'Actual' AS series_type{h} "
            f"FROM {source} GROUP BY {_k(keys)}order_date")


def _fc_rows(keys, with_h):
    h = ", hz.h AS horizon" if with_h else ""
    src = "band CROSS JOIN (VALUES (CAST(7 AS BIGINT)), (14), (30)) hz(h) WHERE step <= hz.h" if with_h else "band"
    return (f"SELECT {_k(keys)}date, CAST(NULL AS DOUBLE) AS daily_net_sales, ROUND(fv, 2) AS forecast_value, "
            f"ROUND(CASE WHEN fv - hw < 0 THEN 0.0 ELSE fv - hw END, 2) AS confidence_lower, "
            f"ROUND(fv + hw, 2) AS confidence_upper, 'Forecast' AS series_type{h} FROM {src}")


ORACLE.update({
    "sales_forecast": qr(_fc_ctes([]) + "\n" + _actuals([], False) + "\nUNION ALL\n" + _fc_rows([], False)),
    "sales_forecast_all": qr(_fc_ctes([]) + "\n" + _actuals([], True) + "\nUNION ALL\n" + _fc_rows([], True)),
    "sales_forecast_by_segment": qr(_fc_ctes(["order_segmentation"]) + "\n"
                                    + _actuals(["order_segmentation"], False) + "\nUNION ALL\n"
                                    + _fc_rows(["order_segmentation"], False)),
    "forecast_models_by_segment": qr(_fc_ctes(["order_segmentation"]) + """
SELECT order_segmentation, last_date, CAST(n AS BIGINT) AS n, alpha, ROUND(level, 2) AS level, sse,
       ROUND(sigma, 2) AS sigma
FROM model"""),
    "forecast_backtest": qr(_fc_ctes([], holdouts=(7, 14, 30)) + """,
test AS (SELECT holdout_days, date, CAST(v AS DOUBLE) AS actual FROM tag
         WHERE date > CAST(last_date_all - CAST(holdout_days AS INTEGER) AS DATE)),
j AS (SELECT t.holdout_days, t.actual, b.fv AS forecast, t.actual - b.fv AS e
      FROM test t JOIN band b ON t.holdout_days = b.holdout_days AND t.date = b.date)
SELECT holdout_days, COUNT(*) AS n, ROUND(AVG(ABS(e)), 4) AS mae, ROUND(SQRT(AVG(e * e)), 4) AS rmse,
       ROUND(AVG(ABS(e) / NULLIF(ABS(actual), 0.0)) * 100, 4) AS mape, ROUND(AVG(e), 4) AS me,
       ROUND(SUM(actual), 4) AS actual_sum, ROUND(SUM(forecast), 4) AS forecast_sum
FROM j GROUP BY holdout_days"""),
})

ORACLE.update({
    "forecast_latest_days": qr(_fc_ctes([]) + ",\nu AS (" + _actuals([], False) + "\nUNION ALL\n"
                               + _fc_rows([], False) + ")\nSELECT * FROM u ORDER BY date DESC LIMIT 5"),
    "sales_forecast_horizon_14": qr(_fc_ctes([]) + ",\nu AS (" + _actuals([], True) + "\nUNION ALL\n"
                                    + _fc_rows([], True) + ")\nSELECT * FROM u "
                                    "WHERE series_type = 'Actual' OR (series_type = 'Forecast' AND horizon = 14)"),
})

ORACLE.update({
    "dashboard_filtered_kpis": q(f"""
SELECT {money('SUM(net_sales)')} AS net_sales, CAST(SUM(order_count) AS BIGINT) AS orders,
       {money(xdiv('SUM(net_sales)', 'SUM(order_count)'))} AS average_order_value,
       CAST(SUM(qty_product) AS BIGINT) AS products_sold,
       ROUND(CAST(SUM(qty_product) AS DOUBLE) / SUM(order_count), 2) AS products_per_order,
       COUNT(DISTINCT customer_ref) AS unique_customers
FROM mart_orders_presentation
WHERE order_date >= {Y_PREV} AND order_date < {Y1} AND customer_profile = 'VIP'
  AND has_complete_12_month_history"""),
    "drill_vip_orders_in_year": q(f"""
SELECT order_id, customer_id, order_date, {money('net_sales')} AS net_sales, qty_product, order_segmentation,
       customer_profile
FROM year_orders WHERE order_segmentation = 'VIP'"""),
    "drill_new_customer_lines_in_year": q(f"""
SELECT order_id, product_id, order_date, quantity, {money('net_sales')} AS net_sales,
       {money('revenue_per_unit')} AS revenue_per_unit, order_segmentation, customer_profile
FROM mart_order_lines WHERE order_date >= {Y0} AND order_date < {Y1} AND order_segmentation = 'New'"""),
})

ORACLE.update({
    "metrics_orders_by_day": q(f"""
SELECT CAST(order_date AS VARCHAR) AS order_date_at_selected_grain, COUNT(*) AS order_count,
       {money('SUM(net_sales)')} AS total_net_sales,
       {money(xdiv('SUM(net_sales)', 'COUNT(net_sales)'))} AS average_order_value,
       CAST(SUM(qty_product) AS BIGINT) AS total_products
FROM mart_orders GROUP BY order_date"""),
    "metrics_orders_by_quarter_segment": q(f"""
SELECT CAST(CAST(DATE_TRUNC('quarter', order_date) AS DATE) AS VARCHAR) AS order_date_at_selected_grain,
       order_segmentation, COUNT(*) AS order_count, {money('SUM(net_sales)')} AS total_net_sales,
       COUNT(DISTINCT customer_id) AS unique_customers, AVG(qty_product) AS average_products_per_order
FROM mart_orders GROUP BY 1, 2"""),
    "metrics_lines_by_month_profile": q(f"""
SELECT CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_date_month, customer_profile,
       {money('SUM(net_sales)')} AS total_net_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_id) AS unique_customers,
       {money(xdiv('SUM(net_sales)', 'SUM(quantity)'))} AS average_revenue_per_unit,
       CAST(SUM(quantity) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0) AS average_quantity_per_order
FROM mart_order_lines GROUP BY 1, 2"""),
})

ORACLE["raw_sales_profile"] = q("""
SELECT COUNT(*) AS row_count, CAST(6 AS BIGINT) AS column_count,
       MIN(date_date) AS min_date, MAX(date_date) AS max_date
FROM raw_sales""")

ORACLE["metrics_segmentation_reconciliation"] = q(f"""
SELECT order_segmentation = {seg('prior_orders_last_12_months')} AS segmentation_reconciliation,
       {seg('prior_orders_last_12_months')} AS derived_order_segmentation, COUNT(*) AS order_count
FROM mart_orders GROUP BY 1, 2""")


# Facts without a dimension row stay, as 'Unknown'.
SEG_SRC = (", seg_src AS (SELECT m.*, COALESCE(c.c_mktsegment, 'Unknown') AS market_segment FROM mart_orders m "
           "LEFT JOIN customer c ON m.customer_id = c.c_custkey)")
NATION_SRC = (", nat_src AS (SELECT m.*, COALESCE(n.n_name, 'Unknown') AS nation FROM mart_orders m "
              "LEFT JOIN customer c ON m.customer_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)")
BRAND_SRC = (", brand_src AS (SELECT l.*, COALESCE(p.p_brand, 'Unknown') AS brand FROM mart_order_lines l "
             "LEFT JOIN part p ON l.product_id = p.p_partkey)")
GROUP_SRC = (", group_src AS (SELECT *, CASE customer_id % 3 WHEN 1 THEN '1' WHEN 2 THEN '2' END AS customer_group "
             "FROM mart_orders)")


def _backtest_tail(keys) -> str:
    kk = keys + ["holdout_days"]
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM b.{k}" for k in kk)
    return f""",
test AS (SELECT {_k(kk)}date, CAST(v AS DOUBLE) AS actual FROM tag
         WHERE date > CAST(last_date_all - CAST(holdout_days AS INTEGER) AS DATE)),
j AS (SELECT {_k(kk, 't.')}t.actual, b.fv AS forecast, t.actual - b.fv AS e
      FROM test t LEFT JOIN band b ON {on} AND t.date = b.date)
SELECT {_k(kk)}COUNT(forecast) AS n, ROUND(AVG(ABS(e)), 4) AS mae, ROUND(SQRT(AVG(e * e)), 4) AS rmse,
       ROUND(AVG(ABS(e) / NULLIF(ABS(actual), 0.0)) * 100, 4) AS mape, ROUND(AVG(e), 4) AS me,
       ROUND(SUM(actual) FILTER (WHERE forecast IS NOT NULL), 4) AS actual_sum,
       ROUND(SUM(forecast), 4) AS forecast_sum
FROM j GROUP BY {", ".join(kk)}"""


ORACLE.update({
    "sales_forecast_by_market_segment": qr(
        SEG_SRC + _fc_ctes(["market_segment"], source="seg_src") + "\n"
        + _actuals(["market_segment"], False, "seg_src") + "\nUNION ALL\n" + _fc_rows(["market_segment"], False)),
    "forecast_models_by_nation": qr(NATION_SRC + _fc_ctes(["nation"], source="nat_src") + """
SELECT nation, last_date, CAST(n AS BIGINT) AS n, alpha, ROUND(level, 2) AS level, sse, ROUND(sigma, 2) AS sigma
FROM model"""),
    "forecast_backtest_by_brand": qr(BRAND_SRC + _fc_ctes(["brand"], holdouts=(7, 14, 30), source="brand_src")
                                     + _backtest_tail(["brand"])),
})

ORACLE.update({
    "sales_forecast_by_customer_group": qr(
        GROUP_SRC + _fc_ctes(["customer_group"], source="group_src") + "\n"
        + _actuals(["customer_group"], False, "group_src") + "\nUNION ALL\n" + _fc_rows(["customer_group"], False)),
    "forecast_backtest_by_month": qr(_fc_ctes(["order_month_start"], holdouts=(7, 14, 30))
                                     + _backtest_tail(["order_month_start"])),
})

# -- checks over data with faults -----------------------------------------------------
# The rules of basketry/plans/faults.py, stated again: ids divisible by a prime.

FAULTS = f"""
, f_sales AS (SELECT CASE WHEN order_id % 97 = 0 THEN -order_id ELSE order_id END AS order_id FROM stg_sales),
f_mart AS (
  SELECT order_id, customer_id, order_date,
         CASE WHEN order_id % 101 = 0 THEN 'Other' WHEN order_id % 103 = 0 THEN NULL ELSE order_segmentation END
           AS order_segmentation,
         CASE WHEN order_id % 107 = 0 THEN 'Other' ELSE customer_profile END AS customer_profile,
         prior_orders_last_12_months + CAST(order_id % 109 = 0 AS BIGINT) AS prior_orders_last_12_months
  FROM mart_orders, range(2) copy(k)
  WHERE order_id % 113 <> 0 AND (k = 0 OR order_id % 127 = 0)),
f_year AS (SELECT * FROM f_mart WHERE order_date >= {Y0} AND order_date < {Y1}),
s_year AS (SELECT * FROM stg_orders WHERE order_date >= {Y0} AND order_date < {Y1}),
f_orders AS (
  SELECT o.order_id, CAST(COALESCE(l.s + CASE o.order_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.010 ELSE 0.011 END,
                                   o.net_sales) AS DECIMAL(38,9)) AS net_sales, l.s
  FROM stg_orders o LEFT JOIN (SELECT order_id, SUM(line_net_sales) AS s FROM stg_sales GROUP BY 1) l USING (order_id))
"""


def qf(body: str) -> str:
    return q(FAULTS + "\n" + body)


_PRIOR = """SELECT m.order_id, m.prior_orders_last_12_months AS stored_count, h.prior_orders_last_12_months AS derived_count
FROM {mart} m JOIN int_order_customer_history h USING (order_id)
WHERE m.prior_orders_last_12_months IS DISTINCT FROM h.prior_orders_last_12_months"""

ORACLE.update({
    "dq_prior_count_reconciliation": q(_PRIOR.format(mart="mart_orders")),
    "faults_prior_count_reconciliation": qf(_PRIOR.format(mart="f_mart")),
    "faults_invalid_segments": qf(f"""SELECT order_id, order_segmentation FROM f_mart
WHERE COALESCE(order_segmentation, '') NOT IN {SEG_IN}"""),
    "faults_lines_without_header": qf("""SELECT order_id FROM f_sales
WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM stg_orders WHERE order_id IS NOT NULL)"""),
    "faults_orphan_line_count": qf("""SELECT COUNT(*) AS orphan_lines FROM f_sales
WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM stg_orders WHERE order_id IS NOT NULL)"""),
    "faults_segmentation_reconciliation": qf(f"""SELECT order_id, derived_segment, stored_segment FROM (
  SELECT order_id, {seg('prior_orders_last_12_months')} AS derived_segment, order_segmentation AS stored_segment
  FROM f_mart) WHERE derived_segment IS DISTINCT FROM stored_segment"""),
    "faults_profile_reconciliation": qf("""SELECT m.order_id, m.customer_id, m.customer_profile AS stored_profile,
       CASE WHEN m.customer_id IS NULL THEN m.order_segmentation ELSE lp.seg END AS derived_profile
FROM f_mart m
LEFT JOIN (SELECT DISTINCT customer_id, LAST_VALUE(order_segmentation) OVER (
             PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id NULLS FIRST
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS seg FROM f_mart) lp
  ON m.customer_id = lp.customer_id
WHERE m.customer_profile IS DISTINCT FROM CASE WHEN m.customer_id IS NULL THEN m.order_segmentation ELSE lp.seg END"""),
    "faults_year_count_match": qf("""SELECT (SELECT COUNT(*) FROM f_year) AS mart_count,
       (SELECT COUNT(*) FROM s_year) AS source_count
WHERE (SELECT COUNT(*) FROM f_year) <> (SELECT COUNT(*) FROM s_year)"""),
    "faults_segmented_year_count_match": qf("""SELECT (SELECT COUNT(*) FROM f_year) AS segmented_count,
       (SELECT COUNT(*) FROM s_year) AS source_count
WHERE (SELECT COUNT(*) FROM f_year) <> (SELECT COUNT(*) FROM s_year)"""),
    "faults_monthly_count_match": qf("""SELECT month_num, NULLIF(SUM(f), 0)::BIGINT AS mart_count,
       NULLIF(SUM(s), 0)::BIGINT AS source_count
FROM (SELECT CAST(MONTH(order_date) AS BIGINT) AS month_num, 1 AS f, 0 AS s FROM f_year
      UNION ALL SELECT CAST(MONTH(order_date) AS BIGINT), 0, 1 FROM s_year)
GROUP BY month_num HAVING SUM(f) <> SUM(s)"""),
    "faults_order_grain_in_year": qf("SELECT order_id FROM f_year WHERE order_id % 127 = 0 GROUP BY order_id"),
    "faults_order_sales_match": qf(f"""SELECT order_id, {money('net_sales')} AS net_sales, {money('s')} AS line_net_sales
FROM f_orders WHERE ABS(COALESCE(net_sales, 0) - COALESCE(s, -1)) > 0.01"""),
    # metric layer: the other timeframes, the value dimension and every focus
    "metrics_orders_by_raw_date": q("""SELECT order_date AS order_date_raw, COUNT(*) AS order_count,
       CAST(SUM(qty_product) AS BIGINT) AS total_products FROM mart_orders GROUP BY 1"""),
    "metrics_orders_by_date": q("""SELECT order_date AS order_date_date, COUNT(*) AS order_count,
       COUNT(*) FILTER (WHERE order_segmentation = 'VIP') AS vip_orders FROM mart_orders GROUP BY 1"""),
    "metrics_orders_by_week_start": q(f"""SELECT {SUNDAY_WEEK} AS order_date_week, COUNT(*) AS order_count,
       {money('SUM(net_sales)')} AS total_net_sales FROM mart_orders GROUP BY 1"""),
    "metrics_lines_by_year": q(f"""SELECT CAST(YEAR(order_date) AS BIGINT) AS order_date_year,
       {money('SUM(net_sales)')} AS total_net_sales, COUNT(DISTINCT product_id) AS unique_products
FROM mart_order_lines GROUP BY 1"""),
    "metrics_orders_by_net_sales": q(f"""SELECT {money('net_sales')} AS net_sales, order_count, unique_customers
FROM (SELECT net_sales, COUNT(*) AS order_count, COUNT(DISTINCT customer_id) AS unique_customers
      FROM mart_orders GROUP BY 1)"""),
    "metrics_lines_by_net_sales": q(f"""SELECT {money('net_sales')} AS net_sales, total_quantity, order_count
FROM (SELECT net_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity, COUNT(DISTINCT order_id) AS order_count
      FROM mart_order_lines GROUP BY 1)"""),
})
_FOCUS = {"revenue": f"{money('SUM(net_sales)')} AS total_net_sales", "orders": "COUNT(*) AS order_count",
          "aov": f"{money(xdiv('SUM(net_sales)', 'COUNT(net_sales)'))} AS average_order_value",
          "basket": "AVG(qty_product) AS average_products_per_order"}
_PRODUCT_FOCUS = {"revenue": f"{money('SUM(net_sales)')} AS total_net_sales",
                  "units": "CAST(SUM(quantity) AS BIGINT) AS total_quantity",
                  "orders": "COUNT(DISTINCT order_id) AS order_count"}
for _focus, _expr in _FOCUS.items():
    ORACLE[f"metrics_focus_{_focus}"] = q(
        f"SELECT order_segmentation, customer_profile, {_expr} FROM mart_orders GROUP BY 1, 2")
for _focus, _expr in _PRODUCT_FOCUS.items():
    ORACLE[f"metrics_product_focus_{_focus}"] = q(
        f"SELECT product_id, {_expr} FROM mart_order_lines WHERE order_segmentation = 'Returning' GROUP BY 1")

ORACLE["dq_mart_orders_null_profile"] = q("""
SELECT 'mart_orders' AS table_name, 'order_id' AS column_name, COUNT(*) FILTER (WHERE order_id IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'customer_id' AS column_name, COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'order_date' AS column_name, COUNT(*) FILTER (WHERE order_date IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'order_year' AS column_name, COUNT(*) FILTER (WHERE order_year IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'order_month' AS column_name, COUNT(*) FILTER (WHERE order_month IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'order_month_start' AS column_name, COUNT(*) FILTER (WHERE order_month_start IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'net_sales' AS column_name, COUNT(*) FILTER (WHERE net_sales IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'qty_product' AS column_name, COUNT(*) FILTER (WHERE qty_product IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'product_line_count' AS column_name, COUNT(*) FILTER (WHERE product_line_count IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'distinct_product_count' AS column_name, COUNT(*) FILTER (WHERE distinct_product_count IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'prior_orders_last_12_months' AS column_name, COUNT(*) FILTER (WHERE prior_orders_last_12_months IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'has_complete_12_month_history' AS column_name, COUNT(*) FILTER (WHERE has_complete_12_month_history IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'order_segmentation' AS column_name, COUNT(*) FILTER (WHERE order_segmentation IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'customer_profile' AS column_name, COUNT(*) FILTER (WHERE customer_profile IS NULL) AS null_count FROM mart_orders
UNION ALL
SELECT 'mart_orders' AS table_name, 'order_count' AS column_name, COUNT(*) FILTER (WHERE order_count IS NULL) AS null_count FROM mart_orders""")

# the same tables by the load's own way, and the two SQL functions
ORACLE["load_csv_orders"] = ORACLE["load_into_namespace"] = ORACLE["raw_orders_profile"]
ORACLE["load_csv_sales"] = ORACLE["raw_sales_profile"]
ORACLE["order_segment_sql_function"] = q("""
SELECT order_segmentation AS segment, COUNT(*) AS orders FROM mart_orders GROUP BY 1""")
ORACLE["sales_forecast_table_function"] = qr(
    _fc_ctes([]) + ",\nu AS (" + _actuals([], True) + "\nUNION ALL\n" + _fc_rows([], True) + ")\nSELECT * EXCLUDE (horizon) FROM u "
    "WHERE series_type = 'Actual' OR (series_type = 'Forecast' AND horizon = 14)")

# headers and lines stored by order id, and ids that occur twice
ORACLE["bucketed_order_product_summary"] = ORACLE["int_order_product_summary"]
ORACLE["bucketed_order_sales_match"] = ORACLE["faults_order_sales_match"]
ORACLE["bucketed_lines_without_header"] = ORACLE["faults_lines_without_header"]
ORACLE["faults_unique_order_ids"] = q("""
SELECT order_id, COUNT(*) AS n_records FROM (
  SELECT order_id FROM stg_orders UNION ALL SELECT order_id FROM stg_orders WHERE order_id % 97 = 0
  UNION ALL SELECT order_id FROM stg_orders WHERE order_id % 194 = 0)
WHERE order_id IS NOT NULL GROUP BY order_id HAVING COUNT(*) > 1""")
ORACLE["lookup_largest_order"] = q(f"""
SELECT order_id, product_id, order_date, quantity, {money('net_sales')} AS net_sales, {money('revenue_per_unit')} AS revenue_per_unit,
       order_segmentation, customer_profile FROM mart_order_lines
WHERE order_id = (SELECT order_id FROM mart_orders ORDER BY net_sales DESC, order_id LIMIT 1)""")
