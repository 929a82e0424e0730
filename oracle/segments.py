"""Check statements of the segmentation queries."""

from oracle.tables import statement as q

BASE = """
, base AS (
  SELECT t.customer_id, c.customer_type, c.nationality, c.age_band,
         date_diff('day', max(t.date), (SELECT max(date) FROM daily_sales))::INTEGER AS recency_days,
         count(*) AS frequency, CAST(sum(t.total_amount) AS DECIMAL(18,2)) AS monetary
  FROM transactions t JOIN customers c USING (customer_id) GROUP BY 1, 2, 3, 4)"""
SCORED = BASE + """
, tiles AS (
  SELECT *, ntile(4) OVER (ORDER BY recency_days DESC, customer_id) AS r_score,
         ntile(4) OVER (ORDER BY frequency, customer_id) AS f_score,
         ntile(4) OVER (ORDER BY monetary, customer_id) AS m_score FROM base),
scored AS (
  SELECT *, r_score + f_score + m_score AS rfm_total,
         CASE WHEN r_score = 4 AND least(f_score, m_score) >= 3 THEN 'Champions'
              WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
              WHEN r_score = 4 THEN 'Recent Customers'
              WHEN r_score = 3 AND m_score >= 3 THEN 'Potential Loyalists'
              WHEN r_score <= 2 AND least(f_score, m_score) >= 3 THEN 'At Risk'
              WHEN r_score = 1 AND f_score >= 3 THEN 'Cant Lose Them'
              WHEN r_score <= 2 AND m_score >= 3 THEN 'Hibernating High Value'
              ELSE 'Low Value' END AS rfm_segment
  FROM tiles)"""
TABLES = "transactions customers daily_sales"
TYPES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def share(value: str) -> str:
    return f"round((count(*) FILTER (customer_type = '{value}'))::DOUBLE * 100 / count(*), 4)"


def moments(c: str) -> str:
    s, s2 = f"sum({c})::DOUBLE", f"sum(CAST({c} * {c} AS DECIMAL(38,4)))::DOUBLE"
    return f"{s} / count(*) AS {c}_mean, sqrt(greatest(0, {s2} - {s} * {s} / count(*)) / count(*)) AS {c}_std"


def described(c: str) -> str:
    s, s2 = f"sum({c})::DOUBLE", f"sum(CAST({c} * {c} AS DECIMAL(38,4)))::DOUBLE"
    quart = ", ".join(
        f"round(quantile_cont({c}::DOUBLE, {p}), 4) AS {n}" for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    )
    return f"""SELECT '{c}' AS "column", count(*) AS "count", round({s} / count(*), 4) AS "mean",
  round(sqrt(greatest(0, {s2} - {s} * {s} / count(*)) / (count(*) - 1)), 4) AS std,
  min({c})::DOUBLE AS "min", {quart}, max({c})::DOUBLE AS "max" FROM base"""


def by_temperature(cold: str, normal: str) -> str:
    return f"""
SELECT CASE WHEN temperature_index < 15 THEN '{cold}' ELSE '{normal}' END AS temp_condition, customer_type,
       count(*) AS num_transactions, round(sum(total_amount)::DOUBLE / count(*), 2) AS avg_basket,
       round(sum(num_items)::DOUBLE / count(*), 2) AS avg_items
FROM transactions JOIN daily_sales USING (date) GROUP BY 1, 2"""


BY_EVENT = """
SELECT event_flag, customer_type, count(*) AS num_transactions,
       round(sum(total_amount)::DOUBLE / count(*), 2) AS avg_basket, round(sum(total_amount)::DOUBLE, 0) AS total_spend
FROM transactions JOIN daily_sales USING (date) {} GROUP BY 1, 2"""

COLUMNS = ["recency_days", "frequency", "monetary"]

SQL = {
    "rfm_segments": q(TABLES, SCORED + "\nSELECT * REPLACE (monetary::DOUBLE AS monetary) FROM scored"),
    "rfm_segment_summary": q(TABLES, SCORED + """
SELECT rfm_segment, customer_type, count(*) AS num_customers,
       round(sum(recency_days)::DOUBLE / count(*), 1) AS avg_recency_days,
       round(sum(frequency)::DOUBLE / count(*), 1) AS avg_frequency,
       round(sum(monetary)::DOUBLE / count(*), 2) AS avg_monetary,
       round(sum(monetary)::DOUBLE, 0) AS total_revenue
FROM scored GROUP BY 1, 2"""),
    "rfm_temp_crosstab": q("transactions daily_sales", by_temperature("Cold snap (<15°C)", "Normal (>=15°C)")),
    "nb_cold_snap_segments": q("transactions daily_sales", by_temperature("Cold snap", "Normal")),
    "rfm_event_crosstab": q("transactions daily_sales", BY_EVENT.format("WHERE event_flag <> 'None'")),
    "nb_event_segments": q("transactions daily_sales", BY_EVENT.format("")),
    "nb_rfm_base": q(TABLES, BASE + "\nSELECT * REPLACE (monetary::DOUBLE AS monetary) FROM base"),
    "nb_describe": q(TABLES, BASE + "\n" + "\nUNION ALL ".join(described(c) for c in COLUMNS)),
    "rfm_standardise": q(TABLES, BASE + ", m AS (SELECT " + ", ".join(moments(c) for c in COLUMNS) + " FROM base)\n"
        + "SELECT customer_id, " + ", ".join(f"round(({c}::DOUBLE - {c}_mean) / {c}_std, 6) AS {c}" for c in COLUMNS)
        + " FROM base, m"),
    "sample_rows": q("transactions", """
SELECT transaction_id, date::VARCHAR AS date, customer_id, customer_type, num_items, total_amount::DOUBLE AS total_amount,
       gross_profit::DOUBLE AS gross_profit, payment_method, promo_applied
FROM transactions ORDER BY md5(transaction_id || ':42'), transaction_id LIMIT 5000"""),
    "segment_crosstab": q(TABLES, SCORED + "\nSELECT rfm_segment, "
        + ", ".join(f'{share(v)} AS "{v}"' for v in TYPES) + " FROM scored GROUP BY 1"),
    "crosstab_melt": q(TABLES, SCORED + "\n" + "\nUNION ALL ".join(
        f"SELECT rfm_segment, '{v}' AS customer_type, {share(v)} AS value FROM scored GROUP BY 1" for v in TYPES)),
}
