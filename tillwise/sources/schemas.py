"""Typed schemas, keys and references of the retail tables.

Money is decimal so that sums are exact; flags are boolean; dates are dates. Ids are
text in files; the operators only compare them, so integer keys work as well.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "products": """sku_id string, division_code int, division_name string, department string,
        product_name string, price_tier string, unit_price decimal(12,2), season string,
        gp_ratio decimal(9,4), is_cold_snap_sensitive boolean, launch_date date, is_active boolean""",
    "customers": """customer_id string, customer_type string, join_date date, nationality string,
        age_band string, gender string, total_visits bigint, total_spend decimal(18,2),
        avg_spend_per_visit decimal(18,2), last_visit_date date""",
    "daily_sales": """date date, day_of_week string, trading_hours int, is_public_holiday boolean,
        event_flag string, temperature_index decimal(5,2), target decimal(18,2),
        actual_sales decimal(18,2), achievement_pct decimal(18,4), num_customers bigint,
        avg_spend decimal(18,2), avg_qty decimal(18,2), avg_unit_price decimal(18,2),
        gross_profit_amt decimal(18,2), gross_profit_ratio decimal(9,4), yoy_pct decimal(18,4),
        promo_flag boolean""",
    "division_daily": """date date, division_code int, division_name string, department string,
        sales_amt decimal(18,2), gp_amt decimal(18,2), gp_ratio decimal(18,4),
        vs_target_pct decimal(18,4), vs_ly_pct decimal(18,4), num_transactions bigint""",
    "transactions": """transaction_id string, date date, timestamp timestamp_ntz, customer_id string,
        customer_type string, num_items bigint, total_amount decimal(18,2),
        gross_profit decimal(18,2), payment_method string, promo_applied boolean""",
    "transaction_items": """transaction_id string, sku_id string, division_code int, quantity int,
        unit_price decimal(12,2), discounted_price decimal(12,2), gross_profit_amt decimal(18,2)""",
    "inventory": """week_start_date date, sku_id string, opening_stock bigint, units_sold bigint,
        units_received bigint, closing_stock bigint, oos_flag boolean, weeks_of_cover double""",
    "forecast_log": """forecast_date date, target_date date, division_code int,
        predicted_sales decimal(18,2), lower_bound decimal(18,2), upper_bound decimal(18,2),
        actual_sales decimal(18,2), error_pct decimal(18,4), context_flags string""",
}

KEYS: dict[str, list[str]] = {
    "products": ["sku_id"],
    "customers": ["customer_id"],
    "daily_sales": ["date"],
    "division_daily": ["date", "division_code"],
    "transactions": ["transaction_id"],
    "inventory": ["week_start_date", "sku_id"],
    "forecast_log": ["target_date", "division_code"],
}

# columns that may be empty; all others must hold a value
OPTIONAL: dict[str, list[str]] = {
    "customers": ["join_date", "last_visit_date"],
    "daily_sales": ["yoy_pct"],
    "division_daily": ["vs_target_pct", "vs_ly_pct"],
    "forecast_log": ["lower_bound", "upper_bound", "actual_sales", "error_pct", "context_flags"],
}

# (table, column, referenced table, referenced column)
REFERENCES: list[tuple[str, str, str, str]] = [
    ("transactions", "customer_id", "customers", "customer_id"),
    ("transaction_items", "transaction_id", "transactions", "transaction_id"),
    ("transaction_items", "sku_id", "products", "sku_id"),
    ("inventory", "sku_id", "products", "sku_id"),
]


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in contract order and type; columns the source cannot give are null."""
    fields = T.StructType.fromDDL(SCHEMAS[table]).fields
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )
