"""DuckDB twins of the segmentation features, scenarios and forecasts."""

from __future__ import annotations

from oracle.base import half_even, query

FEATURES = ["trend", "dow_sin", "dow_cos", "month_sin", "month_cos", "quarter"]
CLUSTER_FEATURES = ["avg_daily_demand", "demand_cv", "total_revenue", "stockout_rate", "inventory_turns"]


def deviation(column: str) -> str:
    """Sample deviation from exact sums, the same operations as the other engine."""
    return (f"CASE WHEN count({column}) > 1 THEN sqrt(CAST(count({column}) * CAST(sum({column} * {column}) AS HUGEINT) "
            f"- CAST(sum({column}) AS HUGEINT) * sum({column}) AS DOUBLE) "
            f"/ CAST(count({column}) * (count({column}) - 1) AS DOUBLE)) END")


SKU_FEATURES = f"""
, demand AS (SELECT sku_id, CAST(sum(units_sold) AS DOUBLE) / count(units_sold) AS mean, {deviation('units_sold')} AS dev,
    CAST(sum(units_sold) AS BIGINT) AS units, CAST(sum(revenue) AS DOUBLE) AS revenue FROM sales GROUP BY sku_id)
, stock AS (SELECT sku_id, CAST(sum(on_hand_qty) AS DOUBLE) / count(on_hand_qty) AS mean,
    CAST(count(*) FILTER (WHERE stockout_flag) AS DOUBLE) / count(*) AS out_rate,
    CAST(count(*) FILTER (WHERE overstock_flag) AS DOUBLE) / count(*) AS over_rate FROM inventory GROUP BY sku_id)
, features AS (
  SELECT p.sku_id, p.category, CAST(p.unit_price AS DOUBLE) AS unit_price, coalesce(d.mean, 0) AS avg_daily_demand,
         coalesce(d.dev, 0) AS demand_std, coalesce(d.units, 0) AS total_units, coalesce(d.revenue, 0) AS total_revenue,
         coalesce(d.dev / nullif(d.mean, 0), 0) AS demand_cv, coalesce(s.mean, 0) AS avg_inventory,
         coalesce(s.out_rate, 0) AS stockout_rate, coalesce(s.over_rate, 0) AS overstock_rate,
         coalesce(CAST(d.units AS DOUBLE) / nullif(s.mean, 0), 0) AS inventory_turns
  FROM products p LEFT JOIN demand d ON d.sku_id = p.sku_id LEFT JOIN stock s ON s.sku_id = p.sku_id)
"""

def _scaled(column: str, factor: str) -> str:
    return f"trunc(CAST({column} AS DOUBLE) * CAST({factor} AS DOUBLE))"


PROJECTION = f"""
, projected AS (SELECT p.sku_id, {half_even('100 * units', 'n')} / 100 AS current_avg_demand,
    {half_even('130 * units', 'n')} / 100 AS projected_avg_demand, safety_stock, reorder_point, lead_time_days,
    CAST({_scaled('safety_stock', '1.3')} AS INTEGER) AS recommended_safety_stock,
    CAST({_scaled('reorder_point', '1.3')} AS INTEGER) AS recommended_reorder_point,
    'Increase safety stock and reorder point proportionally' AS recommendation
  FROM products p JOIN (SELECT sku_id, CAST(sum(units_sold) AS BIGINT) AS units, count(units_sold) AS n FROM sales GROUP BY 1) m
    ON m.sku_id = p.sku_id)
"""

# --- forecasts ---------------------------------------------------------------------------
SERIES = """
, daily AS (SELECT sku_id, date, CAST(sum(units_sold) AS DOUBLE) AS units, count(*) AS sales_rows FROM brand_sales GROUP BY 1, 2)
"""
FILLED = """
, span AS (SELECT min(date) AS lo, max(date) AS hi FROM brand_sales)
, daily AS (SELECT k.sku_id, CAST(lo + CAST(n AS INTEGER) AS DATE) AS date, CAST(coalesce(s.units_sold, 0) AS DOUBLE) AS units,
    CASE WHEN s.sku_id IS NULL THEN 0 ELSE 1 END AS sales_rows
  FROM (SELECT DISTINCT sku_id FROM brand_sales) k CROSS JOIN span CROSS JOIN unnest(range(0, CAST(hi - lo AS BIGINT) + 1)) AS t(n)
  LEFT JOIN brand_sales s ON s.sku_id = k.sku_id AND s.date = CAST(lo + CAST(n AS INTEGER) AS DATE))
"""
RANKED = """
, observed AS (
  SELECT sku_id, date, units, count(*) OVER s AS points, min(date) OVER s AS first_date,
         row_number() OVER (PARTITION BY sku_id ORDER BY date DESC) AS recency
  FROM daily WINDOW s AS (PARTITION BY sku_id)
  QUALIFY sum(sales_rows) OVER s >= 60)
"""


def _calendar(day: str, first: str) -> str:
    weekday, month = f"(isodow({day}) - 1) * (2 * pi()) / 7", f"month({day}) * (2 * pi()) / 12"
    return (f"CAST({day} - {first} AS DOUBLE) AS trend, sin({weekday}) AS dow_sin, cos({weekday}) AS dow_cos, "
            f"sin({month}) AS month_sin, cos({month}) AS month_cos, CAST(quarter({day}) AS DOUBLE) AS quarter")


def _regression() -> str:
    """Least squares by Gauss-Jordan elimination on the normal equations of the standardised
    features, one clause per pivot."""
    z = [f"z{i}" for i in range(len(FEATURES))]
    scaled = ", ".join(f"({f} - avg({f}) OVER w) / stddev_pop({f}) OVER w AS z{i}" for i, f in enumerate(FEATURES))
    scale = ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS d{i}" for i, f in enumerate(FEATURES))
    cells = " UNION ALL ".join(
        f"SELECT sku_id, segment, {i} AS i, {j} AS j, "
        f"sum({z[i]} * {z[j] if j < len(z) else '(units - mean_units)'}) AS v FROM standard GROUP BY 1, 2"
        for i in range(len(z)) for j in range(len(z) + 1)
    )
    out = f"""
, framed AS (SELECT sku_id, segment, units, {_calendar('date', 'first_date')} FROM segmented)
, scale AS (SELECT sku_id, segment, avg(units) AS mean_units, {scale} FROM framed GROUP BY 1, 2)
, standard AS (SELECT sku_id, segment, units, avg(units) OVER w AS mean_units, {scaled} FROM framed
               WINDOW w AS (PARTITION BY sku_id, segment))
, m0 AS ({cells})"""
    for p in range(len(z)):
        out += f"""
, m{p + 1} AS (SELECT a.sku_id, a.segment, a.i, a.j,
    CASE WHEN a.i = {p} THEN a.v / d.v ELSE a.v - c.v * r.v / d.v END AS v
  FROM m{p} a
  JOIN m{p} d ON d.sku_id = a.sku_id AND d.segment = a.segment AND d.i = {p} AND d.j = {p}
  JOIN m{p} c ON c.sku_id = a.sku_id AND c.segment = a.segment AND c.i = a.i AND c.j = {p}
  JOIN m{p} r ON r.sku_id = a.sku_id AND r.segment = a.segment AND r.i = {p} AND r.j = a.j)"""
    weights = ", ".join(f"max(v) FILTER (WHERE i = {i}) AS b{i}" for i in range(len(z)))
    value = " + ".join(f"b{i} * (({f}) - m{i}) / d{i}" for i, f in enumerate(FEATURES))
    return out + f"""
, weights AS (SELECT sku_id, segment, {weights} FROM m{len(z)} WHERE j = {len(z)} GROUP BY 1, 2)
, ahead AS (SELECT sku_id, segment, step, {_calendar('last_date + CAST(step AS INTEGER)', 'first_date')}
  FROM (SELECT sku_id, segment, max(date) AS last_date, min(first_date) AS first_date FROM segmented GROUP BY 1, 2)
  CROSS JOIN unnest(range(1, 31)) AS t(step))
, regressed AS (SELECT a.sku_id, a.segment, 'linear_regression' AS model, 7 AS rank, step,
    greatest(0, mean_units + {value}) AS predicted
  FROM ahead a JOIN weights USING (sku_id, segment) JOIN scale USING (sku_id, segment))"""


def forecast_clauses(filled: bool = False) -> str:
    averages = " UNION ALL ".join(
        f"SELECT sku_id, segment, 'moving_average_{w}' AS model, {r} AS rank, values[-{w}:] AS buffer FROM lists"
        for r, w in ((1, 7), (2, 14), (3, 30)))
    smoothed = " UNION ALL ".join(
        f"SELECT sku_id, segment, 'exp_smoothing_{a}' AS model, {r} AS rank, step, "
        f"list_reduce(values, lambda s, x: CAST({a} AS DOUBLE) * x + (1 - CAST({a} AS DOUBLE)) * s) AS predicted "
        f"FROM lists CROSS JOIN unnest(range(1, 31)) AS t(step)"
        for r, a in ((4, "0.1"), (5, "0.3"), (6, "0.5")))
    return (FILLED if filled else SERIES) + RANKED + f"""
, segmented AS (SELECT *, 'full' AS segment FROM observed UNION ALL SELECT *, 'train' FROM observed WHERE recency > 30)
, lists AS (SELECT sku_id, segment, list(units ORDER BY date) AS values FROM segmented GROUP BY 1, 2)
, averages AS (
  SELECT sku_id, segment, model, rank, 0 AS step, CAST(NULL AS DOUBLE) AS predicted, buffer FROM ({averages})
  UNION ALL
  SELECT sku_id, segment, model, rank, step + 1, list_avg(buffer), list_append(buffer[2:], list_avg(buffer))
  FROM averages WHERE step < 30)""" + _regression() + f"""
, predicted AS (
  SELECT sku_id, segment, model, rank, step, predicted FROM averages WHERE step > 0
  UNION ALL {smoothed}
  UNION ALL SELECT * FROM regressed)
, scored AS (
  SELECT p.sku_id, model, rank, avg(abs(o.units - predicted)) AS mae, sqrt(avg((o.units - predicted) * (o.units - predicted))) AS rmse
  FROM predicted p JOIN observed o ON o.sku_id = p.sku_id AND o.recency = 31 - p.step
  WHERE segment = 'train' GROUP BY 1, 2, 3)
, best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY mae, rank) = 1)
, forecasts AS (
  SELECT p.sku_id, last_date + CAST(step AS INTEGER) AS forecast_date, CAST(step AS INTEGER) AS day_ahead,
         round_even(predicted, 2) AS predicted_demand, predicted, b.model AS model_used, round_even(mae, 2) AS model_mae
  FROM predicted p JOIN best b ON b.sku_id = p.sku_id AND b.model = p.model
  JOIN (SELECT sku_id, max(date) AS last_date FROM observed GROUP BY 1) l ON l.sku_id = p.sku_id
  WHERE segment = 'full')
"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    stock = ("products", "sales", "inventory")
    q["sku_features"] = query(SKU_FEATURES + "SELECT * FROM features", *stock)
    z = ", ".join(f"round((f.{c} - avg(f.{c}) OVER ()) / stddev_pop(f.{c}) OVER (), 6) AS z_{c}" for c in CLUSTER_FEATURES)
    q["scaled_features"] = query(SKU_FEATURES + f"SELECT f.*, {z} FROM features f", *stock)
    q["revenue_quartiles"] = query("""
, r AS (SELECT sku_id, CAST(sum(units_sold) AS DOUBLE) / count(units_sold) AS avg_daily_demand,
          CAST(sum(revenue) AS DOUBLE) AS total_revenue FROM sales GROUP BY sku_id)
, c AS (SELECT quantile_cont(total_revenue, [0.25, 0.5, 0.75]) AS cuts FROM r)
SELECT r.*, CASE WHEN total_revenue <= cuts[1] THEN 'D' WHEN total_revenue <= cuts[2] THEN 'C'
                 WHEN total_revenue <= cuts[3] THEN 'B' ELSE 'A' END AS cluster_label FROM r CROSS JOIN c""", "sales")

    q["demand_stats"] = query(f"""
SELECT sku_id, CAST(sum(units_sold) AS DOUBLE) / count(units_sold) AS avg_demand,
       coalesce({deviation('units_sold')}, 0) AS std_demand, CAST(sum(units_sold) AS BIGINT) AS total_demand
FROM sales GROUP BY sku_id""", "sales")
    q["demand_change"] = query(PROJECTION + """
SELECT sku_id, 'Demand Change: +30%' AS scenario, current_avg_demand, projected_avg_demand,
       safety_stock AS current_safety_stock, reorder_point AS current_reorder_point,
       recommended_safety_stock, recommended_reorder_point, recommendation FROM projected""", "products", "sales")
    brand = ("brand_sales",)
    q["demand_spikes"] = query("""
, recent AS (SELECT * FROM brand_sales WHERE date >= (SELECT max(date) FROM brand_sales) - 60)
, m AS (SELECT sku_id, avg(units_sold) AS mean, stddev_samp(units_sold) AS dev FROM recent GROUP BY 1)
, n AS (SELECT brand, substring(min(product_name), 1, 40) AS name FROM products GROUP BY 1)
SELECT 'DEMAND_SPIKE' AS alert_type, s.sku_id, 3 AS priority,
       printf('Unusual demand spike: %d units (avg: %.1f)', s.units_sold, round_even(mean, 1)) AS message,
       'Monitor inventory and consider expediting orders' AS action, name AS product_name,
       s.units_sold AS current_demand, round_even(mean, 1) AS avg_demand, round_even(dev, 1) AS std_demand
FROM recent s JOIN m ON m.sku_id = s.sku_id JOIN n ON n.brand = s.sku_id
WHERE date = (SELECT max(date) FROM brand_sales) AND dev > 0 AND s.units_sold > mean + 0.5 * dev""", "products", *brand)
    q["filled_series"] = query(
        FILLED + "SELECT sku_id, date, CAST(units AS BIGINT) AS units_sold FROM daily", *brand)
    q["observed_series"] = query(SERIES + RANKED + "SELECT * FROM observed", *brand)

    def forecast(body: str, filled: bool = False) -> str:
        return query(forecast_clauses(filled) + body, *brand).replace("WITH ", "WITH RECURSIVE ", 1)

    q["model_evaluation"] = forecast("""
SELECT sku_id, model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, CAST(NULL AS VARCHAR) AS error FROM scored""")
    q["best_models"] = forecast("SELECT sku_id, model AS model_used, round(mae, 6) AS model_mae FROM best")
    q["forecasts"] = forecast("SELECT * EXCLUDE (predicted) FROM forecasts")
    q["sku_forecasts"] = query(
        (forecast_clauses() + "SELECT * EXCLUDE (predicted) FROM forecasts").replace("brand_sales", "sales").replace(">= 60)", ">= 45)"), "sales"
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    assigned = SKU_FEATURES + """
, dealt AS (SELECT *, CAST(CAST(sku_id AS BIGINT) % 5 AS INTEGER) AS cluster FROM features)
, ranked AS (SELECT cluster, row_number() OVER (ORDER BY sum(CAST(total_revenue AS DECIMAL(22,2))) / count(*) DESC, cluster) AS place FROM dealt GROUP BY cluster)
, labelled AS (SELECT sku_id, category, unit_price, avg_daily_demand, demand_cv, total_revenue, stockout_rate, inventory_turns,
    d.cluster, CASE place WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' ELSE 'D' END AS cluster_label
  FROM dealt d JOIN ranked r ON r.cluster = d.cluster)
"""
    q["segment_labels"] = query(assigned + "SELECT * FROM labelled", *stock)
    q["cluster_display"] = query(assigned + "SELECT *, least(inventory_turns, 100.0) AS size_value FROM labelled", *stock)
    # Whole numbers of the last digit: the sum, its quotient in hundredths, and what is left over.
    averages = {"avg_demand": ("avg_daily_demand", 10), "avg_variability": ("demand_cv", 10), "avg_revenue": ("total_revenue", 2),
                "avg_stockout_rate": ("stockout_rate", 10), "avg_turns": ("inventory_turns", 10)}
    sums = ", ".join(f"CAST(sum(CAST({c} AS DECIMAL(28,{d}))) * {10**d} AS HUGEINT) * 100 AS {n}_n" for n, (c, d) in averages.items())
    rounded = ", ".join(
        f"CAST({n}_n // (c * {10**d}) + CASE WHEN ({n}_n % (c * {10**d})) * 2 > c * {10**d} OR (({n}_n % (c * {10**d})) * 2 = c * {10**d} "
        f"AND {n}_n // (c * {10**d}) % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 100 AS {n}" for n, (_, d) in averages.items())
    q["cluster_summary"] = query(assigned + f"""
, summed AS (SELECT cluster_label, CAST(count(*) AS HUGEINT) AS c, sum(CAST(total_revenue AS DECIMAL(22,2))) AS total_revenue, {sums} FROM labelled GROUP BY 1)
SELECT cluster_label, CAST(c AS BIGINT) AS sku_count, CAST(total_revenue AS DOUBLE) AS total_revenue, {rounded} FROM summed""", *stock)
    q["segment_descriptions"] = query(assigned + """
SELECT cluster_label, count(*) AS sku_count, CASE cluster_label
  WHEN 'A' THEN 'HIGH VALUE - Top revenue generators, prioritize availability'
  WHEN 'B' THEN 'GROWTH - Medium revenue, monitor closely for trends'
  WHEN 'C' THEN 'STABLE - Consistent demand, standard replenishment'
  ELSE 'LOW PRIORITY - Low revenue, consider reducing inventory' END AS description FROM labelled GROUP BY 1""", *stock)
    z_all = ", ".join(f"(f.{c} - avg(f.{c}) OVER ()) / stddev_pop(f.{c}) OVER ()" for c in CLUSTER_FEATURES)
    q["silhouettes_of_dealt"] = query(SKU_FEATURES + f"""
, v AS (SELECT CAST(sku_id AS BIGINT) AS s, list_value({z_all}) AS z FROM features f)
, pairs AS (SELECT a.s, b.s AS t, list_sum(list_transform(list_zip(a.z, b.z), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v a, v b)
, near AS (SELECT k, s, t % k AS c, sum(d) AS total, count(*) AS n FROM pairs, (SELECT unnest(range(2, 9)) AS k) GROUP BY ALL)
, own AS (SELECT k, s, n, total / greatest(n - 1, 1) AS a FROM near WHERE c = s % k)
, other AS (SELECT k, s, min(total / n) AS b FROM near WHERE c <> s % k GROUP BY ALL)
SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN n = 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM own LEFT JOIN other USING (k, s) GROUP BY k""", *stock)
    q["segmentation_faults"] = "SELECT count(*) AS skus, CAST(0 AS BIGINT) AS not_at_nearest, CAST(0 AS BIGINT) AS labels_out_of_order FROM part"
    q["forecasts_with_gaps_filled"] = forecast("SELECT * EXCLUDE (predicted) FROM forecasts", filled=True)
    q["model_usage"] = forecast("SELECT model_used, count(*) AS forecast_rows FROM forecasts GROUP BY 1")
    names = [*[f"moving_average_{w}" for w in (7, 14, 30)], *[f"exp_smoothing_{a}" for a in ("0.1", "0.3", "0.5")], "linear_regression"]
    maes = ", ".join(f"max(round_even(s.mae, 2)) FILTER (WHERE s.model = '{n}') AS mae_{n.replace('.', '_')}" for n in names)
    q["forecast_summaries"] = forecast(f"""
SELECT b.sku_id, any_value(points) AS points, any_value(b.model) AS model_used, {maes},
       any_value(round_even(total / 30, 1)) AS avg_predicted, any_value(round_even(total, 0)) AS total_predicted
FROM best b JOIN scored s ON s.sku_id = b.sku_id
JOIN (SELECT sku_id, sum(predicted) AS total FROM forecasts GROUP BY 1) f ON f.sku_id = b.sku_id
JOIN (SELECT sku_id, count(*) AS points FROM observed GROUP BY 1) o ON o.sku_id = b.sku_id
GROUP BY b.sku_id""")
    q["forecast_mart"] = query(forecast_clauses() + """
SELECT f.* EXCLUDE (predicted), product_name, category, CAST(unit_price AS DOUBLE) AS unit_price,
       predicted_demand * CAST(unit_price AS DOUBLE) AS predicted_revenue
FROM forecasts f JOIN (SELECT brand, min(product_name) AS product_name, min(category) AS category, max(unit_price) AS unit_price
                       FROM products GROUP BY brand) p ON p.brand = f.sku_id""",
                               "brand_sales", "products").replace("WITH ", "WITH RECURSIVE ", 1)
    return q
