"""Check statements of the preparation queries."""

from oracle.tables import statement as q

WEIGHTS = """
, divisions AS (
  SELECT division_code, division_name, department,
         CAST(round(sum(gp_ratio)::DOUBLE / count(*), 4) AS DECIMAL(18,4)) AS gp_ratio
  FROM products GROUP BY 1, 2, 3),
weights AS (
  SELECT s.*, d.division_code, d.division_name, d.department, d.gp_ratio,
    CAST(round(
      CASE WHEN division_code IN (24, 34) THEN 0.155 WHEN division_code IN (22, 32, 27, 37) THEN 0.06
           WHEN division_code IN (23, 33) THEN 0.045 WHEN division_code IN (21, 31, 25, 35) THEN 0.04
           WHEN division_code IN (28, 38) THEN 0.035 WHEN division_code = 29 THEN 0.025
           WHEN division_code = 88 THEN 0.008 ELSE 0.03 END::DOUBLE
      * CASE WHEN division_code IN (21, 31) THEN greatest(0.18::DOUBLE, least((18 - t) / 5, 2.5::DOUBLE))
             WHEN division_code IN (27, 37) THEN greatest(0.6::DOUBLE, least((18 - t) / 6 + 0.6::DOUBLE, 2::DOUBLE))
             WHEN division_code IN (25, 35) THEN greatest(1::DOUBLE, (18 - t) / 12 + 1)
             WHEN division_code = 29 THEN greatest(0.12::DOUBLE, (t - 10) / 18) ELSE 1 END, 6) AS DECIMAL(18,6)) AS weight
  FROM (SELECT *, temperature_index::DOUBLE AS t FROM daily_sales) s, divisions d)"""

UNITS = """
, units AS MATERIALIZED (
  SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, sku_id, sum(quantity)::BIGINT AS units_sold
  FROM transaction_items GROUP BY 1, 2),
spine AS MATERIALIZED (
  SELECT w.week_start, w.week, p.sku_id, p.price_tier, coalesce(u.units_sold, 0) AS units_sold
  FROM (SELECT CAST(lo + CAST(7 * i AS INTEGER) AS DATE) AS week_start, i AS week
        FROM (SELECT lo, unnest(range((hi - lo) // 7 + 1)) AS i
              FROM (SELECT min(week_start) AS lo, max(week_start) AS hi FROM units))) w
  CROSS JOIN products p LEFT JOIN units u ON u.week_start = w.week_start AND u.sku_id = p.sku_id)"""

LEDGER = UNITS + """
, pace AS MATERIALIZED (
  SELECT *, CASE price_tier WHEN 'Entry' THEN 27 WHEN 'Core' THEN 16 WHEN 'Mid' THEN 7 ELSE 3 END AS v FROM spine),
ledger AS (
  SELECT week, week_start, sku_id, v, units_sold, (15 * v)::BIGINT AS opening, 0::BIGINT AS received,
         greatest(0, 15 * v - units_sold)::BIGINT AS closing
  FROM pace WHERE week = 0
  UNION ALL
  SELECT n.week, n.week_start, n.sku_id, n.v, n.units_sold, l.closing,
         CASE WHEN l.closing < 4 * n.v THEN 6 * n.v ELSE 0 END::BIGINT,
         greatest(0, l.closing + CASE WHEN l.closing < 4 * n.v THEN 6 * n.v ELSE 0 END - n.units_sold)::BIGINT
  FROM ledger l JOIN pace n ON n.sku_id = l.sku_id AND n.week = l.week + 1)
SELECT week_start::VARCHAR AS week_start_date, sku_id, opening AS opening_stock, units_sold,
       received AS units_received, closing AS closing_stock, closing = 0 AND units_sold > 0 AS oos_flag,
       round(closing::DOUBLE / v, 2) AS weeks_of_cover
FROM ledger"""

SQL = {
    "prep_event_calendar": q("daily_sales", """
SELECT date::VARCHAR AS date, temperature_index::DOUBLE AS temperature_index, event_flag FROM daily_sales"""),
    "prep_holiday_flag": q("daily_sales", "SELECT date::VARCHAR AS date, is_public_holiday FROM daily_sales"),
    "prep_trading_hours": q("daily_sales", """
SELECT date::VARCHAR AS date, dayname(date) AS day_of_week, trading_hours FROM daily_sales"""),
    "prep_daily_ratios": q("daily_sales", """
SELECT date::VARCHAR AS date, achievement_pct::DOUBLE AS achievement_pct,
       greatest(1, floor(actual_sales::DOUBLE / avg_spend::DOUBLE))::BIGINT AS num_customers,
       avg_unit_price::DOUBLE AS avg_unit_price FROM daily_sales"""),
    "prep_yoy_364": q("daily_sales", """
SELECT a.date::VARCHAR AS date, a.actual_sales::DOUBLE AS actual_sales, b.actual_sales::DOUBLE AS prior_sales,
       round((a.actual_sales - b.actual_sales)::DOUBLE / nullif(b.actual_sales, 0)::DOUBLE, 4) AS yoy_pct
FROM daily_sales a LEFT JOIN daily_sales b ON a.date = b.date + 364"""),
    "prep_division_weight": q("daily_sales products", WEIGHTS + """
SELECT date::VARCHAR AS date, division_code, temperature_index::DOUBLE AS temperature_index, weight::DOUBLE AS weight
FROM weights"""),
    "prep_proportional_allocation": q("daily_sales products", WEIGHTS + """
, split AS (SELECT *, CAST(round(actual_sales::DOUBLE
    * (weight::DOUBLE / sum(weight) OVER (PARTITION BY date)::DOUBLE), 2) AS DECIMAL(18,2)) AS s FROM weights)
SELECT date::VARCHAR AS date, division_code, division_name, department, s::DOUBLE AS sales_amt,
       round(s * gp_ratio, 2)::DOUBLE AS gp_amt, gp_ratio::DOUBLE AS gp_ratio,
       achievement_pct::DOUBLE AS vs_target_pct, yoy_pct::DOUBLE AS vs_ly_pct,
       greatest(1, floor(s::DOUBLE / 80))::BIGINT AS num_transactions
FROM split"""),
    "prep_customer_type": q("customers", """
SELECT customer_id, segment, CASE WHEN segment LIKE 'tourist%' THEN 'tourist' ELSE segment END AS customer_type,
       CASE segment WHEN 'tourist_eu' THEN 'European' WHEN 'tourist_other' THEN 'Other' ELSE 'Australian' END AS nationality
FROM (SELECT customer_id, ['loyalty', 'casual', 'tourist_eu', 'tourist_other'][customer_id % 4 + 1] AS segment
      FROM customers)"""),
    "prep_line_price": q("lines", """
, p AS (SELECT *, CASE WHEN discount > 0 THEN CAST(round(unit_price * CAST(0.8 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2))
                       ELSE unit_price END AS dp FROM lines)
SELECT transaction_id, sku_id, quantity, unit_price::DOUBLE AS unit_price, gp_ratio::DOUBLE AS gp_ratio,
       discount > 0 AS promo, dp::DOUBLE AS discounted_price,
       round(dp * quantity * gp_ratio, 2)::DOUBLE AS gross_profit_amt FROM p"""),
    "prep_basket_rollup": q("transaction_items", """
SELECT transaction_id, sum(quantity)::BIGINT AS num_items,
       sum(discounted_price * quantity)::DOUBLE AS total_amount, sum(gross_profit_amt)::DOUBLE AS gross_profit,
       bool_or(unit_price <> discounted_price) AS promo_applied
FROM transaction_items GROUP BY 1"""),
    "prep_items_with_date": q("transaction_items transactions", """
SELECT i.transaction_id, sku_id, division_code, quantity, unit_price::DOUBLE AS unit_price,
       discounted_price::DOUBLE AS discounted_price, gross_profit_amt::DOUBLE AS gross_profit_amt,
       t.date::VARCHAR AS date
FROM transaction_items i LEFT JOIN transactions t ON t.transaction_id = i.transaction_id"""),
    "prep_week_floor": q("daily_sales", """
SELECT date::VARCHAR AS date, CAST(date_trunc('week', date) AS DATE)::VARCHAR AS week_start FROM daily_sales"""),
    "prep_weekly_units": q("transaction_items", UNITS.split(",\nspine")[0] + """
SELECT week_start::VARCHAR AS week_start, sku_id, units_sold FROM units"""),
    "prep_week_spine": q("products transaction_items", UNITS + """
SELECT week_start::VARCHAR AS week_start, sku_id, units_sold FROM spine"""),
    "prep_stock_ledger": q("products transaction_items", LEDGER, recursive=True),
    "prep_hour_profile": """
SELECT dayname(ts) AS day_of_week, hour(ts)::INTEGER AS hour, count(*) AS visits,
       round(count(*)::DOUBLE * 100 / (sum(count(*)) OVER (PARTITION BY dayname(ts)))::DOUBLE, 4) AS share_pct
FROM events GROUP BY 1, 2""",
}
