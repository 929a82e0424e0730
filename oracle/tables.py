"""Common table expressions that rebuild the retail tables for the check statements."""

_SQL: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, *needs: str):
    def add(body: str) -> None:
        _SQL[name] = (needs, body)

    return add


def given(*names: str) -> str:
    """WITH clause (without the keyword) of the named tables and what they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _SQL[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return ",\n".join(f"{name} AS (\n{_SQL[name][1].strip()}\n)" for name in order)


def statement(tables: str, body: str, recursive: bool = False) -> str:
    """`body` is a SELECT, or further CTEs followed by one when it starts with a comma."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{given(*tables.split())}\n{body.strip()}"


cte("products")("""
SELECT p_partkey AS sku_id,
       CAST(substr(p_brand, 7) AS INTEGER) AS division_code,
       p_brand AS division_name,
       ['Women', 'Men', 'Kids', 'Others'][CAST(substr(p_brand, 7) AS INTEGER) % 4 + 1] AS department,
       p_name AS product_name,
       CASE WHEN p_size <= 12 THEN 'Entry' WHEN p_size <= 25 THEN 'Core'
            WHEN p_size <= 38 THEN 'Mid' ELSE 'Premium' END AS price_tier,
       CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
       p_type AS season,
       CAST(400 + 5 * p_size AS DECIMAL(4,0)) * CAST(0.001 AS DECIMAL(4,3)) AS gp_ratio
FROM part
""")

cte("lines", "products")("""
SELECT l_orderkey AS transaction_id, l_partkey AS sku_id,
       CAST(l_shipdate AS DATE) AS date,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_discount AS DECIMAL(3,2)) AS discount,
       CAST(round(l_extendedprice / l_quantity, 2) AS DECIMAL(12,2)) AS unit_price,
       CAST(l_extendedprice AS DECIMAL(12,2))
         * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS net,
       division_code, division_name, department, gp_ratio
FROM lineitem JOIN products ON l_partkey = sku_id
""")

cte("transaction_items", "lines")("""
SELECT transaction_id, sku_id, division_code, date, quantity, unit_price,
       CAST(round(unit_price * (CAST(1 AS DECIMAL(3,2)) - discount), 2) AS DECIMAL(12,2)) AS discounted_price,
       CAST(round(net * gp_ratio, 2) AS DECIMAL(18,2)) AS gross_profit_amt
FROM lines
""")

cte("division_daily", "lines")("""
SELECT *, CAST(round(sales_amt_gp / sales_amt::DOUBLE, 4) AS DECIMAL(18,4)) AS gp_ratio
FROM (
  SELECT date, division_code, division_name, department,
         CAST(round(sum(net), 2) AS DECIMAL(18,2)) AS sales_amt,
         CAST(round(sum(net * gp_ratio), 2) AS DECIMAL(18,2)) AS gp_amt,
         CAST(round(sum(net * gp_ratio), 2) AS DECIMAL(18,2))::DOUBLE AS sales_amt_gp,
         count(DISTINCT transaction_id) AS num_transactions
  FROM lines GROUP BY ALL
)
""")

cte("daily_base")("""
SELECT CAST(o_orderdate AS DATE) AS date,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS actual_sales,
       count(DISTINCT o_custkey) AS num_customers
FROM orders GROUP BY 1
""")

cte("daily_sales", "daily_base")("""
SELECT date, day_of_week,
       CASE day_of_week WHEN 'Thursday' THEN 12 WHEN 'Sunday' THEN 7 ELSE 9 END AS trading_hours,
       strftime(date, '%m-%d') IN ('01-01', '01-26', '04-25', '12-25', '12-26') AS is_public_holiday,
       event_flag, temperature_index, target, actual_sales,
       CAST(round(actual_sales::DOUBLE / target::DOUBLE, 4) AS DECIMAL(18,4)) AS achievement_pct,
       num_customers, avg_spend, avg_qty,
       CAST(round(avg_spend::DOUBLE / avg_qty::DOUBLE, 2) AS DECIMAL(18,2)) AS avg_unit_price,
       CAST(round(actual_sales * gross_profit_ratio, 2) AS DECIMAL(18,2)) AS gross_profit_amt,
       gross_profit_ratio,
       CAST(round((actual_sales - prior)::DOUBLE / nullif(prior, 0)::DOUBLE, 4) AS DECIMAL(18,4)) AS yoy_pct,
       event_flag = 'None' AND day(date) % 8 = 0 AS promo_flag
FROM (
  SELECT *,
         CASE WHEN month(date) = 5 AND day(date) BETWEEN 21 AND 27 THEN 'Arigato'
              WHEN month(date) = 12 AND day(date) BETWEEN 24 AND 27 THEN 'Christmas'
              WHEN (month(date) = 6 AND day(date) >= 20) OR (month(date) = 7 AND day(date) <= 15) THEN 'EOFY'
              WHEN ((month(date) = 5 AND day(date) >= 24) OR (month(date) = 6 AND day(date) <= 15))
                   AND temperature_index > 14 THEN 'Vivid'
              ELSE 'None' END AS event_flag,
         CAST(round(sum(actual_sales) OVER (PARTITION BY day_of_week)::DOUBLE
              / count(*) OVER (PARTITION BY day_of_week), 2) AS DECIMAL(18,2)) AS target
  FROM (
    SELECT b.date, b.actual_sales, b.num_customers, p.actual_sales AS prior,
           dayname(b.date) AS day_of_week,
           CAST(round(20.5 + 7.5 * cos(2 * pi() * (dayofyear(b.date) - 15) / 365), 2) AS DECIMAL(5,2)) AS temperature_index,
           CAST((590 + dayofyear(b.date) % 61) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(9,4)) AS gross_profit_ratio,
           CAST((210 + dayofyear(b.date) % 41) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS avg_qty,
           CAST(round(b.actual_sales::DOUBLE / b.num_customers, 2) AS DECIMAL(18,2)) AS avg_spend
    FROM daily_base b LEFT JOIN daily_base p ON p.date = b.date - 364
  )
)
""")

cte("transactions", "lines")("""
SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS date, o_orderdate AS timestamp,
       o_custkey AS customer_id, c_mktsegment AS customer_type,
       CAST(coalesce(num_items, 0) AS BIGINT) AS num_items,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
       coalesce(gross_profit, 0) AS gross_profit,
       o_orderpriority AS payment_method,
       coalesce(promo_applied, FALSE) AS promo_applied
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (
  SELECT transaction_id, sum(quantity) AS num_items, bool_or(discount > 0) AS promo_applied,
         CAST(round(sum(net * gp_ratio), 2) AS DECIMAL(18,2)) AS gross_profit
  FROM lines GROUP BY 1
) l ON l.transaction_id = o_orderkey
""")

cte("customers")("""
SELECT c_custkey AS customer_id, c_mktsegment AS customer_type, join_date, n_name AS nationality,
       ['18-24', '25-34', '35-44', '45-54', '55+'][c_custkey % 5 + 1] AS age_band,
       ['F', 'M', 'unspecified'][c_custkey % 3 + 1] AS gender,
       coalesce(visits, 0) AS total_visits,
       coalesce(spend, 0) AS total_spend,
       CAST(round(spend::DOUBLE / visits, 2) AS DECIMAL(18,2)) AS avg_spend_per_visit,
       last_visit_date
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (
  SELECT o_custkey, count(*) AS visits, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS spend,
         CAST(min(o_orderdate) AS DATE) AS join_date, CAST(max(o_orderdate) AS DATE) AS last_visit_date
  FROM orders GROUP BY 1
) o ON o_custkey = c_custkey
""")

cte("dense_days", "division_daily")("""
SELECT s.date, s.division_code, s.division_name, s.department,
       coalesce(d.sales_amt, 0) AS sales_amt, coalesce(d.gp_amt, 0) AS gp_amt, d.gp_ratio
FROM (
  SELECT division_code, division_name, department, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT division_code, division_name, department FROM division_daily),
       (SELECT min(date) AS lo, max(date) AS hi FROM division_daily)
) s LEFT JOIN division_daily d USING (date, division_code)
""")
