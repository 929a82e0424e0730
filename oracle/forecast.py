"""Check statements of the forecast and monitoring queries."""

from oracle.features import JOINED
from oracle.tables import statement as q

TABLES = "daily_sales dense_days"
LOG = JOINED + """
, days AS (
  SELECT date FROM (
    SELECT date, sum(count(*)) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n,
           min(date) OVER () AS first FROM joined GROUP BY date)
  WHERE date >= first + 182 AND n >= 100),
means AS (
  SELECT *, CAST(round(sum(sales_amt) OVER w::DOUBLE / nullif(count(*) OVER w, 0), 2) AS DECIMAL(18,2)) AS p
  FROM joined WINDOW w AS (PARTITION BY division_code, day_of_week ORDER BY date
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
moments AS (
  SELECT *, count(sales_amt - p) OVER w AS n, sum(sales_amt - p) OVER w::DOUBLE AS s1,
         sum(CAST((sales_amt - p) * (sales_amt - p) AS DECIMAL(38,4))) OVER w::DOUBLE AS s2
  FROM means WINDOW w AS (PARTITION BY division_code, day_of_week ORDER BY date
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
log AS (
  SELECT date - 7 AS forecast_date, date AS target_date, division_code, division_name, day_of_week, event_flag,
         p AS predicted_sales,
         CASE WHEN n >= 2 THEN CAST(round(p::DOUBLE - sqrt(greatest(0, s2 - s1 * s1 / n) / n) * 1.0364::DOUBLE, 2)
              AS DECIMAL(18,2)) END AS lower_bound,
         CASE WHEN n >= 2 THEN CAST(round(p::DOUBLE + sqrt(greatest(0, s2 - s1 * s1 / n) / n) * 1.0364::DOUBLE, 2)
              AS DECIMAL(18,2)) END AS upper_bound,
         nullif(sales_amt, 0) AS actual_sales,
         CASE WHEN sales_amt <> 0 AND sales_amt <> p
              THEN CAST(round((sales_amt - p)::DOUBLE / sales_amt::DOUBLE, 4) AS DECIMAL(18,4)) END AS error_pct,
         day_of_week || '/' || event_flag AS context_flags,
         CAST(round((nullif(sales_amt, 0) - p)::DOUBLE * 100 / nullif(sales_amt, 0)::DOUBLE, 6) AS DECIMAL(18,6)) AS se
  FROM moments SEMI JOIN days USING (date))"""
BIAS = LOG + """
, bias AS (
  SELECT *, CASE WHEN count(se) OVER w >= 4 THEN sum(se) OVER w::DOUBLE / count(se) OVER w END AS b
  FROM log WINDOW w AS (PARTITION BY division_code, day_of_week ORDER BY target_date ROWS 5 PRECEDING)),
runs AS (
  SELECT division_code, division_name, day_of_week, count(*) AS n, max(rn) - coalesce(max(rn) FILTER (abs(b) <= 5), 0) AS streak,
         arg_max(b, target_date) AS latest
  FROM (SELECT *, row_number() OVER (PARTITION BY division_code, day_of_week ORDER BY target_date) AS rn
        FROM bias WHERE b IS NOT NULL)
  GROUP BY 1, 2, 3),
flags AS (
  SELECT division_code, division_name, day_of_week, streak AS consecutive_flagged_periods,
         round(latest, 2) AS latest_rolling_bias_pct, latest,
         CASE WHEN latest > 0 THEN 'underestimating' ELSE 'overestimating' END AS direction
  FROM runs WHERE n >= 4 AND streak >= 4)"""
KNOWN_BIAS = LOG + """
, known_bias AS (
  SELECT *, CASE WHEN count(*) OVER w >= 4 THEN sum(se) OVER w::DOUBLE / count(*) OVER w END AS b
  FROM (SELECT * FROM log WHERE actual_sales IS NOT NULL)
  WINDOW w AS (PARTITION BY division_code, day_of_week ORDER BY target_date ROWS 5 PRECEDING))"""
LOOKUP = LOG + """
, lookup AS (
  SELECT day_of_week, event_flag, sum(abs(se))::DOUBLE / count(se) AS mean_mape
  FROM log GROUP BY 1, 2 HAVING count(se) > 0)"""
PLAIN = JOINED + """
, train AS (SELECT * FROM joined WHERE date <= (SELECT max(date) FROM joined) - 56),
model AS (SELECT division_code, day_of_week, CAST(round(sum(sales_amt)::DOUBLE / count(*), 2) AS DECIMAL(18,2)) AS predicted
          FROM train GROUP BY 1, 2),
fitted AS (SELECT * FROM train JOIN model USING (division_code, day_of_week)),
spread AS (SELECT division_code, round(quantile_cont((sales_amt - predicted)::DOUBLE, 0.15), 4) AS lo,
                  round(quantile_cont((sales_amt - predicted)::DOUBLE, 0.85), 4) AS hi FROM fitted GROUP BY 1),
scored AS (
  SELECT j.*, predicted, CAST(round(predicted::DOUBLE + lo, 2) AS DECIMAL(18,2)) AS lower,
         CAST(round(predicted::DOUBLE + hi, 2) AS DECIMAL(18,2)) AS upper
  FROM joined j JOIN model USING (division_code, day_of_week) JOIN spread USING (division_code)
  WHERE date > (SELECT max(date) FROM joined) - 56)"""
LOG_COLUMNS = """forecast_date::VARCHAR AS forecast_date, target_date::VARCHAR AS target_date, division_code,
  predicted_sales::DOUBLE AS predicted_sales, lower_bound::DOUBLE AS lower_bound, upper_bound::DOUBLE AS upper_bound,
  actual_sales::DOUBLE AS actual_sales, error_pct::DOUBLE AS error_pct, context_flags"""
APE = "abs(CAST(round((sales_amt - predicted)::DOUBLE * 100 / nullif(sales_amt, 0)::DOUBLE, 6) AS DECIMAL(18,6)))"
FLAG = """
SELECT date::VARCHAR AS date, c.day_of_week, c.event_flag,
  CASE WHEN c.event_flag IN ('Arigato', 'Christmas', 'Vivid') THEN 'LOW' WHEN mean_mape IS NULL THEN 'MEDIUM'
       WHEN mean_mape < 5 THEN 'HIGH' WHEN mean_mape < 12 THEN 'MEDIUM' ELSE 'LOW' END AS flag,
  CASE WHEN c.event_flag IN ('Arigato', 'Christmas', 'Vivid')
         THEN 'Event week (' || c.event_flag || ') — historical forecast accuracy is lower for irregular events.'
       WHEN mean_mape IS NULL THEN 'Insufficient history for this context.'
       ELSE 'Historical MAPE for ' || c.day_of_week || ' / ' || c.event_flag || ': '
            || printf('%.1f', round(mean_mape, 1)) || '%'
            || CASE WHEN mean_mape < 5 THEN ' — reliable context.' WHEN mean_mape < 12 THEN '.'
                    ELSE ' — forecasts are less reliable in this context.' END END AS explanation
FROM daily_sales c LEFT JOIN lookup l ON l.day_of_week = c.day_of_week AND l.event_flag = c.event_flag"""
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

SQL = {
    "fc_metrics": q(TABLES, PLAIN + f"""
SELECT division_code, count(*) AS num_rows, round(sum({APE})::DOUBLE / nullif(count({APE}), 0), 4) AS mape,
  round(sqrt(sum(CAST((sales_amt - predicted) * (sales_amt - predicted) AS DECIMAL(38,4)))::DOUBLE / count(*)), 4) AS rmse
FROM scored GROUP BY 1"""),
    "fc_quantile_bounds": q(TABLES, PLAIN + """
SELECT date::VARCHAR AS date, division_code, sales_amt::DOUBLE AS sales_amt, predicted::DOUBLE AS predicted,
       lower::DOUBLE AS lower, upper::DOUBLE AS upper FROM scored"""),
    "fc_coverage": q(TABLES, PLAIN + """
SELECT count(*) AS num_rows, count(*) FILTER (sales_amt BETWEEN lower AND upper) AS num_inside,
       round((count(*) FILTER (sales_amt BETWEEN lower AND upper))::DOUBLE / count(*), 4) AS coverage FROM scored"""),
    "fc_accuracy_lookup": q(TABLES, LOOKUP + "\nSELECT * FROM lookup"),
    "fc_accuracy_in_sample": q(TABLES, PLAIN + f"""
SELECT day_of_week, event_flag, sum({APE})::DOUBLE / count({APE}) AS mean_mape
FROM fitted GROUP BY 1, 2 HAVING count({APE}) > 0"""),
    "fc_reliability_flag": q(TABLES, LOOKUP + FLAG),
    "fc_walk_forward_log": q(TABLES, LOG + f"\nSELECT {LOG_COLUMNS} FROM log"),
    "fc_signed_error": q(TABLES, LOG + """
SELECT target_date::VARCHAR AS target_date, division_code, actual_sales::DOUBLE AS actual_sales,
       predicted_sales::DOUBLE AS predicted_sales, se::DOUBLE AS signed_error_pct FROM log"""),
    "fc_context_parse": q(TABLES, LOG + """
SELECT target_date::VARCHAR AS target_date, division_code, context_flags,
       split_part(context_flags, '/', 1) AS day_of_week FROM log"""),
    "fc_log_names": q(TABLES, LOG + f"""
SELECT {LOG_COLUMNS}, division_name, day_of_week AS dow FROM log WHERE actual_sales IS NOT NULL"""),
    "fc_rolling_bias": q(TABLES, BIAS + """
SELECT target_date::VARCHAR AS target_date, division_code, day_of_week, se::DOUBLE AS signed_error_pct,
       b AS rolling_6w_bias FROM bias"""),
    "fc_bias_streak": q(TABLES, BIAS + """
SELECT division_code, day_of_week, n AS num_periods, streak, latest AS latest_bias FROM runs"""),
    "fc_bias_flags": q(TABLES, BIAS + """
SELECT * EXCLUDE (latest), printf('Heads up: %d consecutive weeks %s %s sales in %s by ~%.1f%%.',
  consecutive_flagged_periods, direction, day_of_week, division_name, round(abs(latest), 1)) AS alert FROM flags"""),
    "fc_actual_vs_pred_daily": q(TABLES, PLAIN + """
SELECT date::VARCHAR AS date, sum(sales_amt)::DOUBLE AS actual, sum(predicted)::DOUBLE AS predicted
FROM scored GROUP BY scored.date"""),
    "fc_ci_daily": q(TABLES, PLAIN + """
SELECT date::VARCHAR AS date, sum(sales_amt)::DOUBLE AS actual, sum(predicted)::DOUBLE AS pred_median,
       sum(lower)::DOUBLE AS pred_lower, sum(upper)::DOUBLE AS pred_upper FROM scored GROUP BY scored.date"""),
    "fc_bias_series": q(TABLES, KNOWN_BIAS + """
SELECT target_date::VARCHAR AS target_date, division_code, day_of_week, se::DOUBLE AS signed_error_pct,
       b AS rolling_6w_bias, abs(b) > 5 AS flagged
FROM known_bias WHERE division_code IN (24, 14, 22, 12) AND day_of_week = 'Thursday' AND b IS NOT NULL"""),
    "fc_error_heatmap": q(TABLES, LOG + "\nSELECT division_name, " + ", ".join(
        f"round((sum(se) FILTER (day_of_week = '{d}'))::DOUBLE / nullif(count(se) FILTER (day_of_week = '{d}'), 0), 4)"
        f' AS "{d}"' for d in DAYS) + " FROM log GROUP BY 1"),
}
