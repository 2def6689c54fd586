"""DuckDB side of the adapter: the domain tables as WITH clauses, and exact rounding snippets."""

from __future__ import annotations

TABLES: dict[str, str] = {
    "products": """
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_name AS product_name, p_brand AS brand,
         p_type AS category, p_brand AS sub_category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         2 + p_size % 13 AS lead_time_days,
         5 + (p_partkey * 7) % 46 AS safety_stock,
         1 + (p_partkey * 13) % 20 AS min_order_qty,
         (5 + (p_partkey * 7) % 46) * (3 + p_partkey % 3) AS max_stock_level,
         5 + (p_partkey * 7) % 46 + (2 + p_size % 13) * (2 + p_partkey % 6) AS reorder_point,
         CAST(p_partkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS supplier_id,
         CAST(CASE p_partkey % 4 WHEN 0 THEN 0.95 WHEN 1 THEN 0.97 WHEN 2 THEN 0.98 ELSE 0.99 END
              AS DECIMAL(5,4)) AS slg_target,
         CASE (p_partkey // 4) % 4 WHEN 0 THEN 'EOQ' WHEN 1 THEN 'Fixed Quantity'
              WHEN 2 THEN 'Min-Max' ELSE 'Periodic Review' END AS order_policy
  FROM part""",
    "suppliers": """
  SELECT CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name AS supplier_name,
         5 + s_suppkey % 10 AS avg_lead_time, 1 + s_suppkey % 4 AS lead_time_variance,
         90 + s_suppkey % 9 AS fill_pct, 85 + s_suppkey % 11 AS on_time_pct,
         1000 + 10 * (s_suppkey % 400) AS min_order_value
  FROM supplier""",
    "sales": """
  SELECT CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_sold,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue
  FROM lineitem GROUP BY ALL""",
    "brand_sales": """
  SELECT p_brand AS sku_id, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_sold,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "orders_placed": """
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS BIGINT),
                   CAST(l_extendedprice AS DECIMAL(12,2))) AS order_id,
         CAST(l_shipdate AS DATE) AS order_date,
         CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_suppkey AS VARCHAR) AS supplier_id,
         CAST(l_quantity AS BIGINT) AS order_qty,
         CAST(l_shipdate AS DATE) + CAST(5 + l_suppkey % 10 AS INTEGER) AS expected_delivery_date,
         CAST(l_shipdate AS DATE) + lead AS actual_delivery_date,
         lead AS lead_time_actual,
         90 + (l_orderkey + l_linenumber) % 11 AS fill_pct,
         lead - CAST(5 + l_suppkey % 10 AS INTEGER) AS days_late
  FROM (SELECT *, CAST(greatest(1, 5 + l_suppkey % 10
                 + (l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 17 - 8) AS INTEGER) AS lead
        FROM lineitem)""",
    "inventory": """
  SELECT date, sku_id, on_hand_qty, units_sold,
         before_receipt <= reorder_point AS reorder_triggered,
         on_hand_qty = 0 AS stockout_flag, on_hand_qty > 0 AS instock_flag,
         on_hand_qty > max_stock_level AS overstock_flag,
         supply_tenths, cost_cents, CAST(cost_cents AS DECIMAL(18,0)) * 0.01 AS carrying_cost,
         safety_stock, reorder_point
  FROM (
    SELECT *,
      CASE WHEN 2 * ((on_hand_qty * price_cents * 5) % 10000) > 10000
             OR (2 * ((on_hand_qty * price_cents * 5) % 10000) = 10000
                 AND ((on_hand_qty * price_cents * 5) // 10000) % 2 = 1)
           THEN 1 ELSE 0 END + (on_hand_qty * price_cents * 5) // 10000 AS cost_cents,
      CASE WHEN 2 * ((on_hand_qty * 10) % per_day) > per_day
             OR (2 * ((on_hand_qty * 10) % per_day) = per_day AND ((on_hand_qty * 10) // per_day) % 2 = 1)
           THEN 1 ELSE 0 END + (on_hand_qty * 10) // per_day AS supply_tenths,
      coalesce(lag(on_hand_qty) OVER (PARTITION BY sku_id ORDER BY date), opening) AS before_receipt
    FROM (
      SELECT *, CAST(balance - least(0, min(balance) OVER w) AS BIGINT) AS on_hand_qty,
             CASE WHEN units_sold > 0 THEN units_sold ELSE 5 END AS per_day
      FROM (
        SELECT d.*, opening + sum(received - units_sold) OVER w AS balance
        FROM (
          SELECT p.sku_id, p.max_stock_level, p.safety_stock, p.reorder_point,
                 p.max_stock_level * 7 // 10 AS opening,
                 CAST(p.unit_price * 100 AS BIGINT) AS price_cents,
                 CAST(lo + CAST(n AS INTEGER) AS DATE) AS date,
                 coalesce(s.units_sold, 0) AS units_sold,
                 CASE WHEN n % 28 = CAST(p.sku_id AS BIGINT) % 28 THEN p.min_order_qty ELSE 0 END AS received
          FROM products p
          CROSS JOIN (SELECT min(date) AS lo, max(date) AS hi FROM sales) c
          CROSS JOIN unnest(range(0, CAST(hi - lo AS BIGINT) + 1)) AS t(n)
          LEFT JOIN sales s ON s.sku_id = p.sku_id AND s.date = CAST(lo + CAST(n AS INTEGER) AS DATE)
        ) d
        WINDOW w AS (PARTITION BY sku_id ORDER BY date ROWS UNBOUNDED PRECEDING)
      )
      WINDOW w AS (PARTITION BY sku_id ORDER BY date ROWS UNBOUNDED PRECEDING)
    )
  )""",
}

NEEDS = {"inventory": ["products", "sales"]}


def query(body: str, *tables: str) -> str:
    """``body`` behind the WITH clauses it needs; a body may open with further ``name AS (...)``
    clauses when it starts with a comma."""
    wanted: list[str] = []
    for name in tables:
        for part in [*NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    clauses = ", ".join(f"{name} AS ({TABLES[name]})" for name in wanted)
    return f"WITH {clauses} {body}".strip()


def half_up(num: str, den: str, digits: int) -> str:
    """num / den (num >= 0) rounded half up, exactly, as a double."""
    return (
        f"CAST((2 * {10**digits} * CAST(({num}) AS HUGEINT) + ({den})) "
        f"// (2 * nullif(({den}), 0)) AS DOUBLE) / {10**digits}"
    )


def half_even(num: str, den: str) -> str:
    """num / den (num >= 0) rounded half to even, as a whole number."""
    return (
        f"(({num}) // ({den}) + CASE WHEN 2 * (({num}) % ({den})) > ({den}) "
        f"OR (2 * (({num}) % ({den})) = ({den}) AND (({num}) // ({den})) % 2 = 1) THEN 1 ELSE 0 END)"
    )


def pct(num: str, den: str, digits: int = 2) -> str:
    return half_up(f"100 * ({num})", den, digits)


def times(flag: str) -> str:
    """How often a flag is set, 0 for no rows."""
    return f"count(*) FILTER (WHERE {flag})"


def total(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


def money(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE)"


def avg1(column: str, digits: int = 1) -> str:
    return half_up(f"sum({column})", f"count({column})", digits)
