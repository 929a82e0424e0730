"""Check statements of the feature queries."""

from oracle.tables import statement as q

TABLES = "daily_sales dense_days"
JOINED = """
, joined AS (
  SELECT d.*, s.day_of_week, s.event_flag, s.temperature_index, s.is_public_holiday, s.trading_hours, s.promo_flag
  FROM dense_days d JOIN daily_sales s USING (date))"""
FEATURES = JOINED + """
, features AS (
  SELECT *, isodow(date)::INTEGER - 1 AS dow_num, month(date)::INTEGER AS month,
         dayofyear(date)::INTEGER AS day_of_year, weekofyear(date)::INTEGER AS week_of_year,
         (event_flag = 'Arigato')::INTEGER AS "event_Arigato", (event_flag = 'Christmas')::INTEGER AS "event_Christmas",
         (event_flag = 'EOFY')::INTEGER AS "event_EOFY", (event_flag = 'Vivid')::INTEGER AS "event_Vivid",
         (event_flag = 'LongWeekend')::INTEGER AS "event_LongWeekend",
         lag(sales_amt, 7) OVER h AS lag_7, lag(sales_amt, 14) OVER h AS lag_14, lag(sales_amt, 28) OVER h AS lag_28,
         lag(sales_amt, 364) OVER h AS lag_364,
         sum(sales_amt) OVER r7::DOUBLE / nullif(count(*) OVER r7, 0) AS rolling_7_mean,
         sum(sales_amt) OVER r14::DOUBLE / nullif(count(*) OVER r14, 0) AS rolling_14_mean,
         (temperature_index < 15)::INTEGER AS cold_snap
  FROM joined
  WINDOW h AS (PARTITION BY division_code ORDER BY date),
         r7 AS (PARTITION BY division_code ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         r14 AS (PARTITION BY division_code ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))"""
ROW = "SELECT date::VARCHAR AS date, division_code"
COLS = [
    "division_code", "temperature_index", "trading_hours", "is_public_holiday", "promo_flag",
    "dow_num", "month", "day_of_year", "event_Arigato", "event_Christmas", "event_EOFY", "event_Vivid",
    "event_LongWeekend", "lag_7", "lag_14", "lag_28", "rolling_7_mean", "rolling_14_mean",
]
MATRIX = ", ".join(f'coalesce("{c}"::INTEGER::DOUBLE, 0) AS "x_{c}"' if c in ("is_public_holiday", "promo_flag")
                   else f'coalesce("{c}"::DOUBLE, 0) AS "x_{c}"' for c in COLS)

SQL = {
    "feat_base_join": q("daily_sales division_daily", """
SELECT date::VARCHAR AS date, division_code, division_name, department, sales_amt::DOUBLE AS sales_amt,
       gp_amt::DOUBLE AS gp_amt, gp_ratio::DOUBLE AS gp_ratio, num_transactions, day_of_week, event_flag,
       temperature_index::DOUBLE AS temperature_index, is_public_holiday, trading_hours, promo_flag
FROM (SELECT d.* EXCLUDE (sales_amt_gp), s.day_of_week, s.event_flag, s.temperature_index, s.is_public_holiday,
             s.trading_hours, s.promo_flag FROM division_daily d JOIN daily_sales s USING (date))"""),
    "feat_calendar": q(TABLES, FEATURES + f"\n{ROW}, dow_num, month, day_of_year, week_of_year FROM features"),
    "feat_event_onehot": q(TABLES, FEATURES + f"""
{ROW}, "event_Arigato", "event_Christmas", "event_EOFY", "event_Vivid", "event_LongWeekend" FROM features"""),
    "feat_bool_to_int": q(TABLES, JOINED + f"""
{ROW}, is_public_holiday::INTEGER AS is_public_holiday, promo_flag::INTEGER AS promo_flag FROM joined"""),
    "feat_lags": q(TABLES, FEATURES + f"""
{ROW}, sales_amt::DOUBLE AS sales_amt, lag_7::DOUBLE AS lag_7, lag_14::DOUBLE AS lag_14, lag_28::DOUBLE AS lag_28
FROM features"""),
    "feat_rolling_lagged": q(TABLES, FEATURES + f"""
{ROW}, sales_amt::DOUBLE AS sales_amt, rolling_7_mean, rolling_14_mean FROM features"""),
    "feat_lag_364": q(TABLES, FEATURES + f"""
{ROW}, sales_amt::DOUBLE AS sales_amt, lag_364::DOUBLE AS lag_364 FROM features"""),
    "feat_cold_snap": q(TABLES, FEATURES + f"""
{ROW}, temperature_index::DOUBLE AS temperature_index, cold_snap FROM features"""),
    "build_features": q(TABLES, FEATURES + """
SELECT * REPLACE (date::VARCHAR AS date, sales_amt::DOUBLE AS sales_amt, gp_amt::DOUBLE AS gp_amt,
  gp_ratio::DOUBLE AS gp_ratio, temperature_index::DOUBLE AS temperature_index,
  is_public_holiday::INTEGER AS is_public_holiday, promo_flag::INTEGER AS promo_flag, lag_7::DOUBLE AS lag_7,
  lag_14::DOUBLE AS lag_14, lag_28::DOUBLE AS lag_28, lag_364::DOUBLE AS lag_364) FROM features"""),
    "feat_series_frame": q(TABLES, FEATURES + """
SELECT date::VARCHAR AS ds, sales_amt::DOUBLE AS y, "event_Arigato" AS "Arigato", "event_Christmas" AS "Christmas",
       "event_EOFY" AS "EOFY", "event_Vivid" AS "Vivid", "event_LongWeekend" AS "LongWeekend"
FROM features WHERE division_code = 14"""),
    "split_temporal": q(TABLES, JOINED + f"""
{ROW}, sales_amt::DOUBLE AS sales_amt, date > (SELECT max(date) FROM joined) - 56 AS is_test FROM joined"""),
    "feature_matrix": q(TABLES, FEATURES + f"\n{ROW}, sales_amt::DOUBLE AS sales_amt, {MATRIX} FROM features"),
    "split_validation": q(TABLES, JOINED + f"""
, train AS (SELECT * FROM joined WHERE date <= (SELECT max(date) FROM joined) - 56),
days AS (SELECT date, sum(count(*)) OVER (ORDER BY date DESC) AS after FROM train GROUP BY date)
{ROW}, sales_amt::DOUBLE AS sales_amt,
  after <= floor((SELECT count(*) FROM train) * 0.15::DOUBLE) AS is_validation FROM train JOIN days USING (date)"""),
}
