"""DuckDB twins of the ledger, quality, mart and alert queries."""

from __future__ import annotations

from oracle.base import money, query, times, total

CUTOFF = "(SELECT max(date) FROM inventory) - 30"
NAME = "coalesce(substring(p.product_name, 1, 50), 'Unknown') AS product_name"
ALERTS = f"""
, window_stock AS (SELECT * FROM inventory WHERE date >= {CUTOFF})
, last_stock AS (SELECT * FROM inventory WHERE date = (SELECT max(date) FROM inventory))
, window_sales AS (SELECT * FROM sales WHERE date >= {CUTOFF})
, found AS (
  SELECT 'STOCKOUT' AS alert_type, e.sku_id, CASE WHEN n >= 7 THEN 1 ELSE 2 END AS priority,
         CASE WHEN n >= 7 THEN 'Critical stockout: ' ELSE 'Stockout alert: ' END || n || ' days without inventory' AS message,
         {NAME}, n AS stockout_days,
         CASE WHEN n >= 7 THEN 'Expedite order immediately' ELSE 'Place urgent order' END AS action
  FROM (SELECT sku_id, count(*) AS n FROM window_stock WHERE stockout_flag GROUP BY sku_id) e
  LEFT JOIN products p ON p.sku_id = e.sku_id WHERE n >= 3
  UNION ALL BY NAME
  SELECT 'LOW_STOCK' AS alert_type, i.sku_id, 2 AS priority,
         'Inventory critically low: ' || on_hand_qty || ' units (safety stock: ' || i.safety_stock || ')' AS message,
         {NAME}, on_hand_qty AS current_qty, i.safety_stock, 'Review reorder status' AS action
  FROM last_stock i LEFT JOIN products p ON p.sku_id = i.sku_id WHERE 2 * on_hand_qty < i.safety_stock
  UNION ALL BY NAME
  SELECT 'OVERSTOCK' AS alert_type, i.sku_id, 3 AS priority,
         'Excess inventory: ' || on_hand_qty || ' units (max: ' || p.max_stock_level || ')' AS message,
         {NAME}, on_hand_qty AS current_qty, p.max_stock_level AS max_level,
         on_hand_qty - p.max_stock_level AS excess_units, 'Consider promotion or transfer' AS action
  FROM last_stock i JOIN products p ON p.sku_id = i.sku_id WHERE 2 * on_hand_qty > 3 * p.max_stock_level
  UNION ALL BY NAME
  SELECT 'SLG_BREACH' AS alert_type, r.sku_id, 2 AS priority,
         printf('Service level below target: %.1f%% vs %.1f%% target', round_even(rate * 100, 1), round_even(target * 100, 1)) AS message,
         {NAME}, round_even(rate * 100, 1) AS actual_slg, round_even(target * 100, 1) AS target_slg,
         round_even((target - rate) * 100, 1) AS gap_pct, 'Increase safety stock or reorder point' AS action
  FROM (SELECT i.sku_id, CAST(count(*) FILTER (WHERE instock_flag) AS DOUBLE) / count(*) AS rate,
               CAST(any_value(q.slg_target) AS DOUBLE) AS target
        FROM window_stock i JOIN products q ON q.sku_id = i.sku_id GROUP BY i.sku_id) r
  JOIN products p ON p.sku_id = r.sku_id WHERE rate < target - CAST(0.05 AS DOUBLE)
  UNION ALL BY NAME
  SELECT 'DEMAND_SPIKE' AS alert_type, s.sku_id, 3 AS priority,
         printf('Unusual demand spike: %d units (avg: %.1f)', s.units_sold, round_even(mean, 1)) AS message,
         {NAME}, s.units_sold AS current_demand, round_even(mean, 1) AS avg_demand, round_even(dev, 1) AS std_demand,
         'Monitor inventory and consider expediting orders' AS action
  FROM window_sales s
  JOIN (SELECT sku_id, avg(units_sold) AS mean, stddev_samp(units_sold) AS dev FROM window_sales GROUP BY sku_id) m
    ON m.sku_id = s.sku_id
  LEFT JOIN products p ON p.sku_id = s.sku_id
  WHERE s.date = (SELECT max(date) FROM window_sales) AND dev > 0 AND s.units_sold > mean + 2 * dev
  UNION ALL BY NAME
  SELECT 'SUPPLIER_DELAY' AS alert_type, o.sku_id, CASE WHEN days_late >= 7 THEN 2 ELSE 3 END AS priority,
         'Supplier delivery ' || days_late || ' days late' AS message, {NAME}, order_id, o.supplier_id, days_late,
         'Contact supplier and review backup options' AS action
  FROM orders_placed o LEFT JOIN products p ON p.sku_id = o.sku_id
  WHERE order_date >= {CUTOFF} AND days_late >= 3)
, alerts AS (
  SELECT alert_type, sku_id, priority, CASE priority WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' ELSE 'MEDIUM' END AS priority_label,
         message, CAST((SELECT max(date) FROM inventory) AS TIMESTAMP) AS timestamp, product_name, stockout_days,
         current_qty, safety_stock, max_level, excess_units, actual_slg, target_slg, gap_pct, current_demand,
         avg_demand, std_demand, order_id, supplier_id, days_late, action
  FROM found)
"""
EVERYTHING = ("products", "sales", "inventory", "orders_placed")


def _mean_pct(flag: str) -> str:
    return f"CAST({times(flag)} AS DOUBLE) / count(*) * 100"


def _kpis() -> str:
    return f"""
  SELECT 'Total Revenue' AS metric, {money('revenue')} AS value, 'currency' AS format FROM sales
  UNION ALL SELECT 'Total Units Sold', CAST(sum(units_sold) AS DOUBLE), 'number' FROM sales
  UNION ALL SELECT 'In-Stock Rate', {_mean_pct('instock_flag')}, 'percent' FROM inventory
  UNION ALL SELECT 'Stockout Rate', {_mean_pct('stockout_flag')}, 'percent' FROM inventory
  UNION ALL SELECT 'Overstock Rate', {_mean_pct('overstock_flag')}, 'percent' FROM inventory
  UNION ALL SELECT 'Total Carrying Cost', {money('carrying_cost')}, 'currency' FROM inventory
  UNION ALL SELECT 'SKU Count', CAST(count(*) AS DOUBLE), 'number' FROM products"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    inv = ("products", "inventory")
    stock = ("products", "sales", "inventory")

    q["ledger_rollup"] = query(f"""
SELECT sku_id, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS days, {total('on_hand_qty')} AS on_hand_sum,
       {total('units_sold')} AS units_sold, {times('reorder_triggered')} AS trigger_days,
       {times('stockout_flag')} AS stockout_days, {times('instock_flag')} AS instock_days,
       {times('overstock_flag')} AS overstock_days, CAST(sum(supply_tenths) AS DOUBLE) / 10 AS days_of_supply_sum,
       CAST(sum(cost_cents) AS DOUBLE) / 100 AS carrying_cost
FROM inventory GROUP BY 1, 2""", *inv)
    q["demand_on_calendar"] = query(f"""
SELECT date, {total('units_sold')} AS units_sold, count(*) AS skus FROM inventory GROUP BY date""", *inv)
    q["triggered_orders_rollup"] = query("""
SELECT p.supplier_id, CAST(date_trunc('month', date + CAST(avg_lead_time AS INTEGER)) AS DATE) AS month, count(*) AS orders,
       CAST(sum(min_order_qty) AS BIGINT) AS order_qty, min(date) AS first_order_date,
       max('ORD-' || i.sku_id || '-' || strftime(date, '%Y%m%d')) AS last_order_id
FROM inventory i JOIN products p ON p.sku_id = i.sku_id JOIN suppliers s ON s.supplier_id = p.supplier_id
WHERE reorder_triggered GROUP BY 1, 2""", "suppliers", *inv)

    def rows(table: str, name: str, minimum: int) -> str:
        return (f"SELECT 'row_count' AS check_name, '{name}' AS table_name, CASE WHEN count(*) < {minimum} THEN 'WARN' ELSE 'PASS' END AS status, "
                f"CAST(count(*) AS VARCHAR) AS observed FROM {table} "
                f"UNION ALL SELECT 'required_columns', '{name}', 'PASS', ''")

    def counted(check: str, table: str, expr: str, source: str, bad: str = "FAIL") -> str:
        return (f"SELECT '{check}', '{table}', CASE WHEN {expr} > 0 THEN '{bad}' ELSE 'PASS' END, "
                f"CAST({expr} AS VARCHAR) FROM {source}")

    span = "CAST(min(date) AS VARCHAR) || ' to ' || CAST(max(date) AS VARCHAR)"
    checks = " UNION ALL ".join([
        rows("products", "products", 500), rows("suppliers", "suppliers", 5), rows("sales", "sales", 100000),
        rows("inventory", "inventory", 300000), rows("orders_placed", "orders", 10000),
        counted("null_skus", "products", "count(*) - count(sku_id)", "products"),
        counted("duplicate_skus", "products", "count(*) - count(DISTINCT sku_id)", "products"),
        counted("unknown_suppliers", "products", "count(*)", "products WHERE supplier_id NOT IN (SELECT supplier_id FROM suppliers)"),
        counted("unknown_skus", "sales", "count(*)", "sales WHERE sku_id NOT IN (SELECT sku_id FROM products)"),
        f"SELECT 'sales_date_range', 'sales', 'INFO', {span} FROM sales",
        f"SELECT 'sales_years', 'sales', CASE WHEN year(min(date)) = (SELECT year(min(order_date)) FROM orders_placed) AND year(max(date)) = (SELECT year(max(order_date)) FROM orders_placed) THEN 'PASS' ELSE 'WARN' END, {span} FROM sales",
        counted("negative_on_hand", "inventory", times("on_hand_qty < 0"), "inventory"),
        counted("stockout_flag_consistent", "inventory", times("stockout_flag AND on_hand_qty > 0"), "inventory", "WARN"),
    ])
    q["data_quality"] = query(f"""
, checks AS ({checks})
SELECT check_name AS "check", table_name, status, observed FROM checks
UNION ALL SELECT 'overall', 'all', CASE WHEN {times("status = 'FAIL'")} > 0 THEN 'FAIL' ELSE 'PASS' END,
                 CAST({times("status = 'FAIL'")} AS VARCHAR) FROM checks""", "suppliers", *EVERYTHING)

    q["kpi_summary"] = query(_kpis(), *stock)
    q["kpi_summary_with_value"] = query(_kpis() + """
  UNION ALL SELECT 'Average Inventory Value',
    CAST(sum(on_hand_qty * unit_price) AS DOUBLE) / count(on_hand_qty), 'currency'
  FROM inventory i JOIN products p ON p.sku_id = i.sku_id""", *stock)
    q["kpi_strip"] = query(ALERTS + f"""
, base AS (SELECT (SELECT CAST(sum(revenue) AS DOUBLE) FROM sales) AS total_revenue,
  (SELECT CAST(sum(units_sold) AS BIGINT) FROM sales) AS total_units,
  (SELECT {_mean_pct('instock_flag')} FROM inventory) AS instock_rate,
  (SELECT {_mean_pct('stockout_flag')} FROM inventory) AS stockout_rate,
  (SELECT count(*) FROM products) AS sku_count, (SELECT {times('priority = 1')} FROM alerts) AS critical_alerts)
SELECT *, CASE WHEN instock_rate >= 95 THEN 'green' WHEN instock_rate >= 85 THEN 'orange' ELSE 'red' END AS instock_light,
       CASE WHEN stockout_rate > 10 THEN 'red' WHEN stockout_rate > 5 THEN 'orange' ELSE 'green' END AS stockout_light
FROM base""", *EVERYTHING)
    q["monthly_sales"] = query(f"""
SELECT strftime(date, '%Y-%m') AS month, {money('revenue')} AS revenue, {total('units_sold')} AS units_sold
FROM sales GROUP BY 1""", "sales")
    q["inventory_health_rollup"] = query("""
SELECT sku_id, category, month, health_status, count(*) AS days, CAST(sum(worth) AS DOUBLE) AS inventory_value,
       min(cover) AS min_safety_stock_pct, max(cover) AS max_safety_stock_pct
FROM (SELECT i.sku_id, category, strftime(date, '%Y-%m') AS month, on_hand_qty * unit_price AS worth,
             CAST(on_hand_qty AS DOUBLE) / (CASE WHEN p.safety_stock = 0 THEN 1 ELSE p.safety_stock END) * 100 AS cover,
             CASE WHEN stockout_flag THEN 'Stockout' WHEN on_hand_qty < p.safety_stock THEN 'Low Stock'
                  WHEN overstock_flag THEN 'Overstock' ELSE 'Healthy' END AS health_status
      FROM inventory i JOIN products p ON p.sku_id = i.sku_id) GROUP BY ALL""", *inv)
    daily = f"""
SELECT date, category, {total('on_hand_qty')} AS total_units, CAST(sum(on_hand_qty * unit_price) AS DOUBLE) AS total_value,
       {times('stockout_flag')} AS stockout_skus, {times('overstock_flag')} AS overstock_skus,
       CAST({times('instock_flag')} AS DOUBLE) / count(*) AS instock_rate, {money('carrying_cost')} AS carrying_cost
FROM inventory i JOIN products p ON p.sku_id = i.sku_id GROUP BY date, category"""
    q["daily_health"] = query(daily, *inv)
    q["daily_instock_by_category"] = query(
        f"SELECT date, category, instock_rate * 100 AS instock_rate_pct FROM ({daily})", *inv)
    q["sales_detail"] = query("""
SELECT s.sku_id, date, units_sold, CAST(revenue AS DOUBLE) AS revenue, product_name, brand, category, sub_category,
       strftime(date, '%Y-%m') AS month, CAST(weekofyear(date) AS INTEGER) AS week, dayname(date) AS day_of_week
FROM sales s JOIN products p ON p.sku_id = s.sku_id""", "products", "sales")
    q["daily_sales_by_category"] = query(f"""
SELECT date, category, {total('units_sold')} AS units_sold, {money('revenue')} AS revenue
FROM sales s JOIN products p ON p.sku_id = s.sku_id GROUP BY date, category""", "products", "sales")
    q["monthly_trend_by_category"] = query(f"""
SELECT strftime(date, '%Y-%m') AS month, category, {total('units_sold')} AS units_sold, {money('revenue')} AS revenue,
       count(DISTINCT s.sku_id) AS active_skus
FROM sales s JOIN products p ON p.sku_id = s.sku_id GROUP BY 1, 2""", "products", "sales")
    for name, top in (("top_products", 50), ("top_ten_products", 10)):
        q[name] = query(f"""
SELECT s.sku_id, product_name, category, {total('units_sold')} AS units_sold, {money('revenue')} AS revenue
FROM sales s JOIN products p ON p.sku_id = s.sku_id GROUP BY 1, 2, 3
ORDER BY sum(revenue) DESC, s.sku_id LIMIT {top}""", "products", "sales")

    deviation = ("sqrt(CAST(count(*) * CAST(sum(lead_time_actual * lead_time_actual) AS HUGEINT) "
                 "- CAST(sum(lead_time_actual) AS HUGEINT) * sum(lead_time_actual) AS DOUBLE) "
                 "/ nullif(CAST(count(*) * (count(*) - 1) AS DOUBLE), 0))")
    q["supplier_scorecard"] = query(f"""
, m AS (SELECT supplier_id, count(order_id) AS total_orders, {total('order_qty')} AS total_qty,
    CAST(sum(lead_time_actual) AS DOUBLE) / count(*) AS actual_avg_lead_time, {deviation} AS lead_time_std,
    CAST(sum(fill_pct) AS DOUBLE) / 100 / count(*) AS avg_fill_rate,
    CAST({times('days_late <= 0')} AS DOUBLE) / count(*) AS on_time_rate,
    CAST(sum(days_late) AS DOUBLE) / count(*) AS avg_days_late
  FROM orders_placed GROUP BY supplier_id)
SELECT m.*, supplier_name, avg_lead_time, lead_time_variance, fill_pct / 100 AS fill_rate,
       on_time_pct / 100 AS on_time_delivery_rate, CAST(min_order_value AS DOUBLE) AS min_order_value,
       round_even(avg_fill_rate * 30 + on_time_rate * 40 + (1 - coalesce(lead_time_std, 0) / actual_avg_lead_time) * 30, 1)
         AS reliability_score
FROM m JOIN suppliers s ON s.supplier_id = m.supplier_id""", "suppliers", "orders_placed")
    q["monthly_supplier_performance"] = query(f"""
SELECT strftime(order_date, '%Y-%m') AS month, supplier_id, count(order_id) AS orders,
       CAST({times('days_late <= 0')} AS DOUBLE) / count(*) AS on_time_rate,
       CAST(sum(fill_pct) AS DOUBLE) / 100 / count(*) AS fill_rate
FROM orders_placed GROUP BY 1, 2""", "orders_placed")
    q["contract_rates"] = query("""
SELECT supplier_name, CAST(fill_pct AS DOUBLE) AS fill_rate_pct, CAST(on_time_pct AS DOUBLE) AS on_time_rate_pct,
       avg_lead_time AS lead_time FROM suppliers""", "suppliers")
    q["exception_mart"] = query(ALERTS + """
SELECT a.*, p.category FROM alerts a LEFT JOIN products p ON p.sku_id = a.sku_id""", *EVERYTHING)
    q["exception_mart_without_alerts"] = query("""
SELECT * FROM (
  SELECT i.sku_id, product_name, category, on_hand_qty, i.safety_stock, i.reorder_point,
         CASE WHEN stockout_flag THEN 'Stockout' WHEN on_hand_qty < i.safety_stock THEN 'Low Stock'
              WHEN overstock_flag THEN 'Overstock' END AS exception_type
  FROM inventory i JOIN products p ON p.sku_id = i.sku_id WHERE date = (SELECT max(date) FROM inventory))
WHERE exception_type IS NOT NULL""", *inv)
    q["exception_mart_empty_alerts"] = q["exception_mart_without_alerts"]
    q["category_totals"] = query(f"""
SELECT category, {money('revenue')} AS revenue, {total('units_sold')} AS units_sold
FROM sales s JOIN products p ON p.sku_id = s.sku_id GROUP BY category""", "products", "sales")
    q["monthly_instock_by_category"] = query(f"""
SELECT strftime(date, '%Y-%m') AS month, category, {_mean_pct('instock_flag')} AS instock_pct
FROM inventory i JOIN products p ON p.sku_id = i.sku_id GROUP BY 1, 2""", *inv)
    q["stockout_heatmap"] = query("""
, cells AS (SELECT category, month FROM (SELECT DISTINCT category FROM inventory i JOIN products p ON p.sku_id = i.sku_id) CROSS JOIN (
    SELECT strftime(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH)), '%Y-%m') AS month
    FROM inventory))
, counted AS (SELECT category, strftime(date, '%Y-%m') AS month, count(*) FILTER (WHERE stockout_flag) AS n
    FROM inventory i JOIN products p ON p.sku_id = i.sku_id GROUP BY 1, 2)
SELECT c.category, c.month, coalesce(n, 0) AS stockout_days
FROM cells c LEFT JOIN counted d ON d.category IS NOT DISTINCT FROM c.category AND d.month = c.month""", *inv)
    q["alert_counts"] = query(ALERTS + """
SELECT 'priority' AS dimension, priority_label AS label, count(*) AS alerts FROM alerts GROUP BY 2
UNION ALL SELECT 'type', alert_type, count(*) FROM alerts GROUP BY 2""", *EVERYTHING)

    q["alerts"] = query(ALERTS + "SELECT * FROM alerts", *EVERYTHING)
    q["alert_summary"] = query(ALERTS + f"""
SELECT priority_label, alert_type, count(*) AS alerts, {times('priority = 1')} AS critical, {times('priority = 2')} AS high
FROM alerts GROUP BY GROUPING SETS ((priority_label), (alert_type), ())""", *EVERYTHING)
    q["urgent_alerts"] = query(ALERTS + """
SELECT priority_label, alert_type, sku_id, message, action FROM alerts WHERE priority <= 2
ORDER BY priority, alert_type, sku_id, message, order_id NULLS FIRST LIMIT 10""", *EVERYTHING)
    q["consecutive_stockout_alerts"] = query(f"""
, empty_days AS (
  SELECT sku_id, date, date - CAST(row_number() OVER (PARTITION BY sku_id ORDER BY date) AS INTEGER) AS island
  FROM inventory WHERE stockout_flag)
, longest AS (SELECT sku_id, max(n) AS n FROM (SELECT sku_id, island, count(*) AS n FROM empty_days GROUP BY 1, 2) GROUP BY 1)
SELECT 'STOCKOUT' AS alert_type, l.sku_id, CASE WHEN n >= 7 THEN 1 ELSE 2 END AS priority,
       CASE WHEN n >= 7 THEN 'Critical stockout: ' ELSE 'Stockout alert: ' END || n || ' days without inventory' AS message,
       CASE WHEN n >= 7 THEN 'Expedite order immediately' ELSE 'Place urgent order' END AS action,
       {NAME}, n AS stockout_days
FROM longest l LEFT JOIN products p ON p.sku_id = l.sku_id WHERE n >= 3""", *inv)

    q["clean_catalogue"] = _clean_catalogue()
    parts = [
        ("products", "products", "reorder_point", "category"), ("suppliers", "suppliers", "avg_lead_time", "supplier_name"),
        ("sales", "sales", "units_sold", "date"), ("inventory", "inventory", "on_hand_qty", "date"),
        ("orders", "orders_placed", "lead_time_actual", "actual_delivery_date"),
    ]
    q["star_read_back"] = query(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, CAST(sum({measure}) AS DOUBLE) AS total, CAST(min({text}) AS VARCHAR) AS first, "
        f"CAST(max({text}) AS VARCHAR) AS last FROM {table}" for name, table, measure, text in parts), "suppliers", *EVERYTHING)
    counted = {
        "kpi_summary": "SELECT 7", "monthly_sales_trend": "SELECT count(DISTINCT strftime(date, '%Y-%m')) FROM sales",
        "daily_inventory_health": "SELECT count(*) FROM (SELECT DISTINCT date, category FROM inventory i JOIN products p ON p.sku_id = i.sku_id)",
        "daily_sales_by_category": "SELECT count(*) FROM (SELECT DISTINCT date, category FROM sales s JOIN products p ON p.sku_id = s.sku_id)",
        "monthly_sales_trend_by_category": "SELECT count(*) FROM (SELECT DISTINCT strftime(date, '%Y-%m'), category FROM sales s JOIN products p ON p.sku_id = s.sku_id)",
        "top_50_products": "SELECT least(50, count(DISTINCT sku_id)) FROM sales",
        "supplier_scorecard": f"SELECT count(*) FROM ({q['supplier_scorecard']})" if "supplier_scorecard" in q else "SELECT count(*) FROM suppliers",
        "monthly_supplier_performance": "SELECT count(*) FROM (SELECT DISTINCT strftime(order_date, '%Y-%m'), supplier_id FROM orders_placed)",
        "exception_dashboard": """SELECT count(*) FROM inventory i JOIN products p ON p.sku_id = i.sku_id
          WHERE date = (SELECT max(date) FROM inventory) AND (stockout_flag OR on_hand_qty < i.safety_stock OR overstock_flag)""",
    }
    q["mart_manifest"] = query(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(({one}) AS BIGINT) AS rows" for name, one in counted.items()), "suppliers", *EVERYTHING)
    q["reloaded_months"] = query("""
SELECT 'sales' AS table_name, strftime(date, '%Y-%m') AS month, count(*) AS rows,
       CAST(sum(units_sold * CASE WHEN strftime(date, '%Y-%m') >= '1998-01' THEN 2 ELSE 1 END) AS BIGINT) AS total FROM sales GROUP BY 2
UNION ALL SELECT 'orders', strftime(order_date, '%Y-%m'), count(*), CAST(sum(order_qty) AS BIGINT) FROM orders_placed GROUP BY 2""",
                                 "sales", "orders_placed")
    q["load_manifest"] = query(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {table}" for name, table in (
            ("dim_suppliers", "suppliers"), ("dim_products", "products"), ("fact_sales", "sales"),
            ("fact_inventory", "inventory"), ("fact_replenishment_orders", "orders_placed"))),
        "suppliers", *EVERYTHING)
    return q


# The expected mapping, written out so that a wrong entry in the package shows.
CATEGORY_MAP = {
    "Decor": "Office Supplies",
    "Office Supplies": "Office Supplies",
    "Furniture": "Furniture",
    "Storage Furniture": "Furniture",
    "Paper": "Office Supplies",
    "Facilities": "Breakroom",
    "Shipping, Packing & Mailing Supplies": "Shipping",
    "Shipping Supplies": "Shipping",
    "Arts & Crafts": "Office Supplies",
    "Computers & Accessories": "Technology",
    "Coffee, Water & Snacks": "Breakroom",
    "Printers & Scanners": "Technology",
    "Phones, Cameras & Electronics": "Technology",
    "Audio": "Technology",
    "Tablets & iPads": "Technology",
    "Hard Drives & Data Storage": "Technology",
}


def _clean_catalogue() -> str:
    names = [*CATEGORY_MAP, "Garden"]
    listed = ", ".join("'" + n + "'" for n in names)
    mapped = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_MAP.items())
    return f"""
WITH raw AS (SELECT p_partkey, p_brand || '-' || nullif(p_size, 50) AS sku, nullif(p_name, 'old bolt') AS title,
    nullif(p_brand, 'Brand#7') AS brand, ([{listed}])[p_size % {len(names)} + 1] AS category,
    nullif(p_type, 'SMALL') AS sub_category,
    CASE WHEN p_type = 'PROMO' THEN 'N/A' ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price
  FROM part),
firsts AS (SELECT * FROM raw WHERE sku IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sku ORDER BY p_partkey) = 1)
SELECT sku AS sku_id, coalesce(substring(title, 1, 200), 'Unknown Product') AS product_name,
       coalesce(brand, 'Generic') AS brand, CASE category {mapped} ELSE 'Office Supplies' END AS category,
       coalesce(sub_category, 'General') AS sub_category, coalesce(TRY_CAST(price AS DOUBLE), 25.0) AS unit_price
FROM firsts""".strip()
