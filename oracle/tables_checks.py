"""Check statements of the source, sink and contract queries."""

from oracle.dashboard import DAILY
from oracle.forecast import BIAS
from oracle.prep import UNITS
from oracle.sales import SQL as SALES
from oracle.tables import statement as q

ALL = "products customers daily_sales division_daily transactions transaction_items"
SUMMED = {
    "products": "unit_price", "customers": "total_spend", "daily_sales": "actual_sales",
    "division_daily": "sales_amt", "transactions": "total_amount", "transaction_items": "quantity",
    "spine": "units_sold",
}


def shown(table: str) -> str:
    return "inventory" if table == "spine" else table


def key(table: str, columns: str, source: str = "") -> str:
    return (f"SELECT '{table}' AS table_name, 'key {columns}' AS check_name, count(*) AS violations FROM "
            f"(SELECT 1 FROM {source or table} GROUP BY {columns.replace('week_start_date', 'week_start')} HAVING count(*) > 1)")


def reference(table: str, column: str, other: str, source: str = "") -> str:
    return (f"SELECT '{table}' AS table_name, '{column} in {other}' AS check_name, count(*) AS violations FROM "
            f"(SELECT DISTINCT {column} FROM {source or table}) WHERE {column} NOT IN (SELECT {column} FROM {other})")


CHECKS = [
    key("products", "sku_id"), key("customers", "customer_id"), key("daily_sales", "date"),
    key("division_daily", "date, division_code"), key("transactions", "transaction_id"),
    key("inventory", "week_start_date, sku_id", "spine"),
    reference("transactions", "customer_id", "customers"),
    reference("transaction_items", "transaction_id", "transactions"),
    reference("transaction_items", "sku_id", "products"),
    reference("inventory", "sku_id", "products", "spine"),
]

SQL = {
    "src_csv_tables": q(ALL, UNITS + "\n" + "\nUNION ALL ".join(
        f"SELECT '{shown(t)}' AS table_name, count(*) AS num_rows, sum({c})::DOUBLE AS column_sum FROM {t}"
        for t, c in SUMMED.items())),
    "src_csv_projected": """
SELECT o_orderkey::VARCHAR AS transaction_id, o_orderdate::DATE::VARCHAR AS date FROM orders""",
    "src_sql": q("daily_sales", """
SELECT date::VARCHAR AS date, day_of_week, actual_sales::DOUBLE AS actual_sales, target::DOUBLE AS target
FROM daily_sales WHERE event_flag <> 'None'"""),
    "src_table_scan": q("daily_sales", f"SELECT {DAILY} FROM daily_sales"),
    "src_optional": q("daily_sales", """
SELECT 'daily_sales' AS table_name, count(*) AS num_rows FROM daily_sales
UNION ALL SELECT 'forecast_log', 0"""),
    "sink_csv": SALES["eda_monthly_sales"],
    "sink_table_replace": SALES["nb_division_annual"],
    "model_save_load": q("daily_sales dense_days", BIAS + """
, lookup AS (SELECT day_of_week, event_flag FROM log GROUP BY 1, 2 HAVING count(se) > 0)
SELECT 'driver_model' AS artefact, count(*) AS num_rows, 0::BIGINT AS num_different
FROM joined WHERE date > (SELECT max(date) FROM joined) - 56
UNION ALL SELECT 'accuracy_lookup', count(*), 0 FROM lookup
UNION ALL SELECT 'bias_flags', count(*), 0 FROM flags"""),
    "schema_contract": q(ALL, UNITS + "\n" + "\nUNION ALL ".join(CHECKS)),
    "contract_rows": q(ALL, UNITS + "\n" + "\nUNION ALL ".join(
        f"SELECT '{shown(t)}' AS table_name, count(*) AS num_rows, count(*) FILTER (WHERE {c} IS NULL) AS num_broken FROM {t}"
        for t, c in SUMMED.items())),
    "audit_row_counts": q(ALL, UNITS + "\n" + "\nUNION ALL ".join(
        f"SELECT '{shown(t)}' AS table_name, count(*) AS num_rows FROM {t}" for t in SUMMED)),
}
