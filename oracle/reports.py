"""DuckDB twins of the inventory, supplier and parameter reports.

Joins are written row by row, fan-out included, so that the pre-aggregated Spark plans are
checked against what the plain join would give.
"""

from __future__ import annotations

from oracle.base import avg1, half_up, money, pct, query, times, total

OUT, IN, OVER = times("i.stockout_flag"), times("i.instock_flag"), times("i.overstock_flag")
TARGET = "CAST(p.slg_target * 100 AS DOUBLE)"
SUPPLY = ("sum(i.on_hand_qty) * count(s.units_sold)", "count(i.on_hand_qty) * sum(s.units_sold)")
SELLING = "sum(s.units_sold) > 0"
BOTH_BY_DAY = """FROM products p LEFT JOIN inventory i ON i.sku_id = p.sku_id
LEFT JOIN sales s ON s.sku_id = p.sku_id AND s.date = i.date"""
BOTH_BY_SKU = """FROM products p LEFT JOIN sales s ON s.sku_id = p.sku_id
LEFT JOIN inventory i ON i.sku_id = p.sku_id"""
MONTH = "CAST(date_trunc('month', i.date) AS DATE)"
TURNS = (
    f"CASE WHEN avg(i.on_hand_qty) > 0 THEN "
    f"{half_up('sum(s.units_sold) * CAST(count(i.on_hand_qty) AS HUGEINT)', 'sum(i.on_hand_qty)', 2)} ELSE 0 END"
)
# Joins on SKU alone multiply rows; products are the only table wider than needed.
PER_SKU = """
, stock AS (SELECT sku_id, count(*) AS days, count(*) FILTER (WHERE instock_flag) AS filled,
    count(*) FILTER (WHERE stockout_flag) AS empty, count(*) FILTER (WHERE overstock_flag) AS excess,
    sum(carrying_cost) AS cost FROM inventory GROUP BY sku_id)
, sold AS (SELECT sku_id, sum(revenue) AS revenue FROM sales GROUP BY sku_id)
"""


def _hundredths(num: str, den: str) -> str:
    return f"((20000 * {num} + {den}) // (2 * {den}))"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    inv = ("products", "inventory")
    both = ("products", "sales", "inventory")

    q["instock_by_sku"] = query(f"""
SELECT *, CASE WHEN instock_rate_pct >= slg_target_pct THEN 'Meeting SLG' ELSE 'Below SLG' END AS slg_status
FROM (SELECT p.sku_id, p.product_name, p.category, count(*) AS total_days, {IN} AS instock_days,
             {pct(IN, 'count(*)')} AS instock_rate_pct, {TARGET} AS slg_target_pct
      FROM inventory i JOIN products p ON p.sku_id = i.sku_id
      GROUP BY p.sku_id, p.product_name, p.category, p.slg_target)""", *inv)
    q["instock_by_category"] = query(f"""
SELECT p.category, count(*) AS total_days, {IN} AS instock_days, {pct(IN, 'count(*)')} AS instock_rate_pct
FROM inventory i JOIN products p ON p.sku_id = i.sku_id GROUP BY p.category""", *inv)
    q["instock_by_month"] = query(f"""
SELECT {MONTH} AS month, count(*) AS total_days, {IN} AS instock_days, {pct(IN, 'count(*)')} AS instock_rate_pct
FROM inventory i GROUP BY 1""", *inv)
    q["worst_instock"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, {pct(IN, 'count(*)')} AS instock_rate_pct,
       {OUT} AS stockout_days, {TARGET} AS slg_target_pct
FROM inventory i JOIN products p ON p.sku_id = i.sku_id
GROUP BY p.sku_id, p.product_name, p.category, p.slg_target
ORDER BY instock_rate_pct ASC NULLS LAST, p.sku_id LIMIT 20""", *inv)

    q["overstock_by_sku"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, p.max_stock_level, {avg1('i.on_hand_qty')} AS avg_inventory,
       {avg1('s.units_sold')} AS avg_daily_demand,
       CASE WHEN {SELLING} THEN {half_up(*SUPPLY, 1)} END AS days_of_supply,
       {OVER} AS overstock_days, {pct(OVER, 'count(*)')} AS overstock_rate_pct,
       {money('i.carrying_cost')} AS total_carrying_cost,
       CAST(p.unit_price AS DOUBLE) * (CAST(sum(i.on_hand_qty) AS DOUBLE) / count(i.on_hand_qty)) AS avg_inventory_value
{BOTH_BY_DAY} GROUP BY p.sku_id, p.product_name, p.category, p.max_stock_level, p.unit_price""", *both)
    q["overstock_by_category"] = query(f"""
SELECT p.category, count(DISTINCT p.sku_id) AS sku_count, {avg1('i.on_hand_qty')} AS avg_inventory,
       {OVER} AS overstock_events, {pct(OVER, 'count(*)')} AS overstock_rate_pct,
       {money('i.carrying_cost')} AS total_carrying_cost
FROM products p LEFT JOIN inventory i ON i.sku_id = p.sku_id GROUP BY p.category""", *inv)
    q["excess_weeks_of_supply"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, {avg1('i.on_hand_qty')} AS avg_inventory,
       {avg1('s.units_sold')} AS avg_daily_demand, {half_up(SUPPLY[0], f'7 * {SUPPLY[1]}', 1)} AS weeks_of_supply,
       {money('i.carrying_cost')} AS total_carrying_cost,
       CAST(p.unit_price AS DOUBLE) * (CAST(sum(i.on_hand_qty) AS DOUBLE) / count(i.on_hand_qty)) AS tied_up_capital
{BOTH_BY_DAY} GROUP BY p.sku_id, p.product_name, p.category, p.unit_price
HAVING {SELLING} AND {SUPPLY[0]} > 5.25 * {SUPPLY[1]}
ORDER BY weeks_of_supply DESC NULLS FIRST, p.sku_id LIMIT 30""", *both)
    q["overstock_by_month"] = query(f"""
SELECT {MONTH} AS month, {OVER} AS overstock_events, count(*) AS total_sku_days,
       {pct(OVER, 'count(*)')} AS overstock_rate_pct, {money('i.carrying_cost')} AS monthly_carrying_cost
FROM inventory i GROUP BY 1""", *inv)

    q["exception_summary"] = query(PER_SKU + f"""
, rated AS (
  SELECT p.*, empty, excess, cost, revenue, {_hundredths('filled', 'days')} AS in_h,
         {_hundredths('empty', 'days')} AS out_h, {_hundredths('excess', 'days')} AS over_h,
         CAST(p.slg_target * 10000 AS BIGINT) AS target_h
  FROM products p LEFT JOIN stock ON stock.sku_id = p.sku_id LEFT JOIN sold ON sold.sku_id = p.sku_id)
SELECT sku_id, product_name, category, supplier_id, target_h / 100 AS slg_target_pct, in_h / 100 AS instock_rate,
       empty AS stockout_days, out_h / 100 AS stockout_rate, excess AS overstock_days, over_h / 100 AS overstock_rate,
       CAST(cost AS DOUBLE) AS total_carrying_cost, CAST(revenue AS DOUBLE) AS total_revenue,
       CASE WHEN in_h < target_h THEN 1 ELSE 0 END AS below_slg_flag,
       CASE WHEN empty > 30 THEN 1 ELSE 0 END AS high_stockout_flag,
       CASE WHEN excess > 100 THEN 1 ELSE 0 END AS high_overstock_flag,
       (CASE WHEN in_h < target_h THEN 30000 ELSE 0 END + 20 * out_h + 5 * over_h
        + CASE WHEN revenue > 50000 THEN 20000 ELSE 0 END + 50) // 100 / 10 AS priority_score,
       CASE WHEN empty > 50 THEN 'CRITICAL: Increase safety stock immediately'
            WHEN empty > 30 THEN 'HIGH: Review and increase reorder point'
            WHEN in_h < target_h THEN 'MEDIUM: Adjust safety stock parameters'
            WHEN excess > 150 THEN 'LOW: Reduce max stock level'
            WHEN excess > 100 THEN 'LOW: Review ordering frequency'
            ELSE 'OK: No action needed' END AS recommended_action
FROM rated""", *both)
    q["top_exceptions"] = query(f"""
, sku AS (
  SELECT p.sku_id, p.product_name, p.category, {TARGET} AS slg_target_pct, {pct(IN, 'count(*)')} AS instock_rate,
         {OUT} AS stockout_days, {OVER} AS overstock_days, {money('s.revenue')} AS total_revenue
  {BOTH_BY_DAY} GROUP BY p.sku_id, p.product_name, p.category, p.slg_target)
SELECT *, CASE WHEN stockout_days > 50 THEN 'Stockout Crisis' WHEN instock_rate < slg_target_pct THEN 'Below SLG'
               WHEN overstock_days > 150 THEN 'Severe Overstock' ELSE 'Review Needed' END AS exception_type
FROM sku WHERE stockout_days > 30 OR instock_rate < slg_target_pct OR overstock_days > 100
ORDER BY stockout_days DESC, round((slg_target_pct - instock_rate) * 100) DESC, sku_id LIMIT 20""", *both)
    q["exception_counts_by_category"] = query(PER_SKU + """
SELECT category, count(DISTINCT p.sku_id) AS total_skus,
       count(*) FILTER (WHERE (20000 * filled + days) // (2 * days) < CAST(slg_target * 10000 AS BIGINT)) AS below_slg_count,
       count(*) FILTER (WHERE empty > 30) AS high_stockout_count,
       count(*) FILTER (WHERE excess > 100) AS high_overstock_count
FROM products p LEFT JOIN stock ON stock.sku_id = p.sku_id GROUP BY category""", *both)

    q["turns_by_sku"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, CAST(p.unit_price AS DOUBLE) AS unit_price,
       CAST(sum(s.units_sold) AS DOUBLE) AS total_units_sold, {avg1('i.on_hand_qty')} AS avg_inventory,
       {TURNS} AS inventory_turns,
       CASE WHEN avg(i.on_hand_qty) > 0 AND {SELLING} THEN
         {half_up('365 * CAST(sum(i.on_hand_qty) AS HUGEINT)', 'CAST(count(i.on_hand_qty) AS HUGEINT) * sum(s.units_sold)', 1)}
       END AS days_to_turn
{BOTH_BY_SKU} GROUP BY p.sku_id, p.product_name, p.category, p.unit_price""", *both)
    q["turns_by_category"] = query(f"""
SELECT p.category, CAST(sum(s.units_sold) AS DOUBLE) AS total_units_sold, {avg1('i.on_hand_qty')} AS avg_inventory,
       {TURNS} AS inventory_turns
{BOTH_BY_SKU} GROUP BY p.category""", *both)
    q["turns_by_month"] = query(f"""
SELECT {MONTH} AS month, {total('s.units_sold')} AS monthly_sales, {avg1('i.on_hand_qty')} AS avg_inventory,
       {TURNS} AS monthly_turns
FROM sales s JOIN inventory i ON i.sku_id = s.sku_id AND i.date = s.date GROUP BY 1""", *both)
    q["slow_movers"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, CAST(sum(s.units_sold) AS DOUBLE) AS total_units_sold,
       {avg1('i.on_hand_qty')} AS avg_inventory, {TURNS} AS inventory_turns
{BOTH_BY_SKU} GROUP BY p.sku_id, p.product_name, p.category HAVING avg(i.on_hand_qty) > 0
ORDER BY inventory_turns ASC NULLS LAST, p.sku_id LIMIT 20""", *both)
    q["category_turns"] = query("""
SELECT p.category, CAST(sum(s.units_sold) AS DOUBLE)
       / (CAST(sum(i.on_hand_qty) AS DOUBLE) / count(i.on_hand_qty)) AS inventory_turns
FROM sales s JOIN products p ON p.sku_id = s.sku_id JOIN inventory i ON i.sku_id = s.sku_id
GROUP BY p.category""", *both)

    q["stockout_by_sku"] = query(f"""
SELECT *, CASE WHEN stockout_rate_pct > allowed_stockout_pct THEN 'Exceeds Allowed Stockout'
               ELSE 'Within Tolerance' END AS status
FROM (SELECT p.sku_id, p.product_name, p.category, p.supplier_id, count(*) AS total_days, {OUT} AS stockout_days,
             {pct(OUT, 'count(*)')} AS stockout_rate_pct, {TARGET} AS slg_target_pct,
             CAST((1 - p.slg_target) * 100 AS DOUBLE) AS allowed_stockout_pct
      FROM inventory i JOIN products p ON p.sku_id = i.sku_id
      GROUP BY p.sku_id, p.product_name, p.category, p.supplier_id, p.slg_target)""", *inv)
    q["stockout_by_month"] = query(f"""
SELECT {MONTH} AS month, count(DISTINCT i.sku_id) AS total_skus, {OUT} AS stockout_events,
       count(*) AS total_sku_days, {pct(OUT, 'count(*)')} AS stockout_rate_pct
FROM inventory i GROUP BY 1""", *inv)
    q["stockout_by_category"] = query(f"""
SELECT p.category, count(DISTINCT p.sku_id) AS sku_count, {OUT} AS stockout_events,
       count(*) AS total_sku_days, {pct(OUT, 'count(*)')} AS stockout_rate_pct
FROM inventory i JOIN products p ON p.sku_id = i.sku_id GROUP BY p.category""", *inv)
    q["longest_stockouts"] = query("""
, empty_days AS (
  SELECT sku_id, date, date - CAST(row_number() OVER (PARTITION BY sku_id ORDER BY date) AS INTEGER) AS island
  FROM inventory WHERE stockout_flag)
SELECT e.sku_id, product_name, category, min(date) AS stockout_start, max(date) AS stockout_end,
       count(*) AS consecutive_days
FROM empty_days e JOIN products p ON p.sku_id = e.sku_id
GROUP BY e.sku_id, product_name, category, island HAVING count(*) >= 3
ORDER BY consecutive_days DESC, stockout_start, e.sku_id LIMIT 50""", *inv)
    q["mean_stockout_days"] = query("""
SELECT category, CAST(sum(days_out) AS DOUBLE) / count(*) AS avg_stockout_days,
       CAST(sum(days) AS BIGINT) AS total_stockouts
FROM (SELECT sku_id, count(*) AS days, count(*) FILTER (WHERE on_hand_qty = 0) AS days_out
      FROM inventory GROUP BY sku_id) d
JOIN products p ON p.sku_id = d.sku_id GROUP BY category""", *inv)

    on_time = times("o.days_late <= 0")
    mean_lead = "(CAST(sum(o.lead_time_actual) AS DOUBLE) / count(o.lead_time_actual))"
    spread = f"stddev_samp(o.lead_time_actual) / nullif({mean_lead}, 0) * 100"
    ordered = ("suppliers", "orders_placed")
    kept = "FROM suppliers s LEFT JOIN orders_placed o ON o.supplier_id = s.supplier_id"
    q["supplier_performance"] = query(f"""
SELECT s.supplier_id, s.supplier_name, s.avg_lead_time AS expected_lead_time,
       s.lead_time_variance AS expected_variance, {avg1('o.lead_time_actual')} AS actual_avg_lead_time,
       round(stddev_samp(o.lead_time_actual), 2) AS actual_lead_time_stddev, s.fill_pct / 100 AS expected_fill_rate,
       {half_up('sum(o.fill_pct)', '100 * count(o.fill_pct)', 4)} AS actual_fill_rate,
       s.on_time_pct / 100 AS expected_otd, {pct(on_time, 'count(*)')} AS actual_otd_pct, count(*) AS total_orders
{kept} GROUP BY ALL""", *ordered)
    q["supplier_by_month"] = query(f"""
SELECT o.supplier_id, s.supplier_name, CAST(date_trunc('month', o.order_date) AS DATE) AS month,
       count(*) AS orders, {avg1('o.lead_time_actual')} AS avg_lead_time,
       {half_up('sum(o.fill_pct)', '100 * count(o.fill_pct)', 4)} AS avg_fill_rate, {pct(on_time, 'count(*)')} AS otd_pct
FROM orders_placed o JOIN suppliers s ON s.supplier_id = o.supplier_id GROUP BY 1, 2, 3""", *ordered)
    q["late_deliveries"] = query("""
SELECT o.supplier_id, supplier_name, order_id, o.sku_id, product_name, order_date, expected_delivery_date,
       actual_delivery_date, days_late, lead_time_actual
FROM orders_placed o JOIN suppliers s ON s.supplier_id = o.supplier_id JOIN products p ON p.sku_id = o.sku_id
WHERE actual_delivery_date > expected_delivery_date ORDER BY days_late DESC, order_id LIMIT 50""",
                                 "products", *ordered)
    q["reliability_score"] = query(f"""
SELECT s.supplier_id, s.supplier_name, {half_up('sum(o.fill_pct)', 'count(o.fill_pct)', 1)} AS fill_rate_score,
       {pct(on_time, 'count(*)', 1)} AS otd_score, round(100 - {spread}, 1) AS consistency_score,
       round(CAST(sum(o.fill_pct) AS DOUBLE) / count(o.fill_pct) * 0.3 + 100.0 * {on_time} / count(*) * 0.4
             + (100 - coalesce({spread}, 0)) * 0.3, 1) AS overall_reliability_score
{kept} GROUP BY s.supplier_id, s.supplier_name""", *ordered)
    q["delivery_scorecard"] = query(f"""
SELECT s.supplier_name, count(o.order_id) AS total_orders,
       CAST(sum(o.days_late) AS DOUBLE) / count(o.days_late) AS avg_delay_days,
       CAST({on_time} AS DOUBLE) / count(*) AS on_time_rate
FROM orders_placed o JOIN suppliers s ON s.supplier_id = o.supplier_id GROUP BY s.supplier_name""", *ordered)

    needed = half_up("sum(s.units_sold) * p.lead_time_days + p.safety_stock * count(s.units_sold)",
                     "count(s.units_sold)", 0)
    q["reorder_point_evaluation"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, p.reorder_point, p.safety_stock, p.lead_time_days,
       {avg1('s.units_sold')} AS avg_daily_demand, {needed} AS calculated_rop, p.reorder_point - {needed} AS rop_difference,
       CASE WHEN p.reorder_point * count(s.units_sold) < sum(s.units_sold) * p.lead_time_days
              THEN 'ROP Too Low - Stockout Risk'
            WHEN p.reorder_point * count(s.units_sold) > 2 * sum(s.units_sold) * p.lead_time_days
                 + p.safety_stock * count(s.units_sold) THEN 'ROP Too High - Overstock Risk'
            ELSE 'ROP Adequate' END AS rop_status
FROM products p LEFT JOIN sales s ON s.sku_id = p.sku_id
GROUP BY p.sku_id, p.product_name, p.category, p.reorder_point, p.safety_stock, p.lead_time_days""",
                                          "products", "sales")
    q["minmax_evaluation"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, p.min_order_qty, p.max_stock_level, p.safety_stock,
       {avg1('i.on_hand_qty')} AS avg_inventory, {avg1('s.units_sold')} AS avg_daily_demand,
       CASE WHEN {SELLING} THEN {half_up('p.max_stock_level * count(s.units_sold)', 'sum(s.units_sold)', 1)} END AS max_days_coverage,
       CASE WHEN p.max_stock_level < p.safety_stock * 2 THEN 'Max Too Low'
            WHEN {SELLING} AND p.max_stock_level * count(s.units_sold) > 90 * sum(s.units_sold)
              THEN 'Max Too High (>90 days)' ELSE 'Max Adequate' END AS max_status,
       CASE WHEN {SELLING} AND p.min_order_qty * count(s.units_sold) < 3 * sum(s.units_sold) THEN 'MOQ Too Low'
            WHEN {SELLING} AND p.min_order_qty * count(s.units_sold) > 30 * sum(s.units_sold) THEN 'MOQ Too High'
            ELSE 'MOQ Adequate' END AS moq_status
{BOTH_BY_SKU} GROUP BY p.sku_id, p.product_name, p.category, p.min_order_qty, p.max_stock_level, p.safety_stock""", *both)
    q["order_policy_effectiveness"] = query(f"""
SELECT p.order_policy, count(DISTINCT p.sku_id) AS sku_count, {pct(IN, 'count(*)')} AS avg_instock_rate,
       {pct(OUT, 'count(*)')} AS avg_stockout_rate, {pct(OVER, 'count(*)')} AS avg_overstock_rate,
       {money('i.carrying_cost')} AS total_carrying_cost
FROM products p LEFT JOIN inventory i ON i.sku_id = p.sku_id GROUP BY p.order_policy""", *inv)
    q["parameters_to_adjust"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, p.order_policy, {pct(OUT, 'count(*)')} AS stockout_rate,
       {pct(OVER, 'count(*)')} AS overstock_rate,
       CASE WHEN {OUT} > 30 THEN 'Increase Safety Stock/ROP' WHEN {OVER} > 100 THEN 'Decrease Max/Safety Stock'
            ELSE 'No Change Needed' END AS recommended_action
FROM products p LEFT JOIN inventory i ON i.sku_id = p.sku_id
GROUP BY p.sku_id, p.product_name, p.category, p.order_policy HAVING {OUT} > 30 OR {OVER} > 100""", *inv)

    q["safety_stock_by_sku"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, p.safety_stock, p.reorder_point, {avg1('i.on_hand_qty')} AS avg_inventory,
       {avg1('s.units_sold')} AS avg_daily_demand, {OUT} AS stockout_days, {pct(OUT, 'count(*)')} AS stockout_rate_pct,
       CASE WHEN {OUT} > 30 THEN 'Safety Stock Too Low'
            WHEN 2 * sum(i.on_hand_qty) > 3 * p.max_stock_level * count(i.on_hand_qty) THEN 'Safety Stock Too High'
            ELSE 'Adequate' END AS safety_stock_status,
       CASE WHEN {SELLING} THEN {half_up('p.safety_stock * count(s.units_sold)', 'sum(s.units_sold)', 1)} END
         AS safety_stock_days_coverage
{BOTH_BY_DAY}
GROUP BY p.sku_id, p.product_name, p.category, p.safety_stock, p.reorder_point, p.max_stock_level""", *both)
    q["inadequate_safety_stock"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, p.safety_stock AS current_safety_stock,
       {avg1('s.units_sold')} AS avg_daily_demand, p.lead_time_days, {OUT} AS stockout_days,
       {pct(OUT, 'count(*)')} AS stockout_rate_pct,
       round(2 * stddev_samp(s.units_sold) * sqrt(p.lead_time_days), 0) AS recommended_safety_stock
{BOTH_BY_DAY} GROUP BY p.sku_id, p.product_name, p.category, p.safety_stock, p.lead_time_days
HAVING {OUT} > 20 ORDER BY stockout_days DESC, p.sku_id LIMIT 30""", *both)
    q["excess_safety_stock"] = query(f"""
SELECT p.sku_id, p.product_name, p.category, p.safety_stock AS current_safety_stock,
       {avg1('i.on_hand_qty')} AS avg_inventory, p.max_stock_level, {avg1('s.units_sold')} AS avg_daily_demand,
       CASE WHEN {SELLING} THEN {half_up(*SUPPLY, 1)} END AS days_of_supply,
       {money('i.carrying_cost')} AS total_carrying_cost
{BOTH_BY_DAY} GROUP BY p.sku_id, p.product_name, p.category, p.safety_stock, p.max_stock_level
HAVING sum(i.on_hand_qty) > p.max_stock_level * count(i.on_hand_qty)
ORDER BY total_carrying_cost DESC NULLS FIRST, p.sku_id LIMIT 30""", *both)
    return q
