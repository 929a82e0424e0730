"""Model features of division days.

The windows run per division over a dense calendar: one row per day, so a division's
frame is as long as its history in days.
"""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.numeric import dbl, mean_over

# --- fixed values -----------------------------------------------------------
LAGS = [7, 14, 28]
ROLLING = [7, 14]
YEAR_LAG = 364
FEATURE_COLS = [
    "division_code", "temperature_index", "trading_hours", "is_public_holiday", "promo_flag",
    "dow_num", "month", "day_of_year",
    "event_Arigato", "event_Christmas", "event_EOFY", "event_Vivid", "event_LongWeekend",
    "lag_7", "lag_14", "lag_28", "rolling_7_mean", "rolling_14_mean",
]
TEST_WEEKS = 8
VALIDATION_SHARE = 0.15
# ----------------------------------------------------------------------------
CONTEXT = ["day_of_week", "event_flag", "temperature_index", "is_public_holiday", "trading_hours", "promo_flag"]


def base_join(division_days: DataFrame, daily: DataFrame) -> DataFrame:
    """Division days with the context of the day."""
    return division_days.join(daily.select("date", *CONTEXT), "date")


def calendar_columns() -> dict:
    return {
        "dow_num": cal.dow_num("date"),
        "month": F.month("date"),
        "day_of_year": F.dayofyear("date"),
        "week_of_year": F.weekofyear("date"),
    }


def event_columns(prefix: str = "event_") -> dict:
    return {f"{prefix}{e}": F.coalesce((F.col("event_flag") == e).cast("int"), F.lit(0)) for e in cal.EVENTS}


def flag_columns(df: DataFrame) -> dict:
    return {c: F.col(c).cast("int") for c in ("is_public_holiday", "promo_flag") if c in df.columns}


def lag_columns() -> dict:
    history = Window.partitionBy("division_code").orderBy("date")
    return {f"lag_{k}": F.lag("sales_amt", k).over(history) for k in LAGS}


def rolling_columns() -> dict:
    """Mean of the previous rows without today; shorter at the start of the history."""
    history = Window.partitionBy("division_code").orderBy("date")
    return {f"rolling_{k}_mean": mean_over("sales_amt", history.rowsBetween(-k, -1)) for k in ROLLING}


def year_lag_column() -> dict:
    history = Window.partitionBy("division_code").orderBy("date")
    return {f"lag_{YEAR_LAG}": F.lag("sales_amt", YEAR_LAG).over(history)}


def cold_snap_column() -> dict:
    return {"cold_snap": (F.col("temperature_index") < cal.COLD_SNAP_BELOW).cast("int")}


def build_features(joined: DataFrame) -> DataFrame:
    """All feature columns in one projection; the windows share one shuffle and one sort."""
    return joined.withColumns(
        {
            **calendar_columns(), **event_columns(), **flag_columns(joined), **lag_columns(),
            **rolling_columns(), **year_lag_column(), **cold_snap_column(),
        }
    )


def series_frame(joined: DataFrame, code: int) -> DataFrame:
    """One division as (ds, y) with event dummies."""
    return joined.where(F.col("division_code") == code).select(
        F.col("date").alias("ds"), F.col("sales_amt").alias("y"),
        *[c.alias(name) for name, c in event_columns("").items()],
    )


def label_split(features: DataFrame, weeks: int = TEST_WEEKS) -> DataFrame:
    """Adds `is_test`: the last weeks before the newest date."""
    cutoff = F.date_sub(features.agg(F.max("date")).scalar(), 7 * weeks)
    return features.withColumn("is_test", F.col("date") > cutoff)


def temporal_split(features: DataFrame, weeks: int = TEST_WEEKS) -> tuple[DataFrame, DataFrame]:
    labelled = label_split(features, weeks)
    return labelled.where(~F.col("is_test")).drop("is_test"), labelled.where("is_test").drop("is_test")


def validation_split(train: DataFrame, share: float = VALIDATION_SHARE) -> DataFrame:
    """Adds `is_validation`: the newest whole days holding at most this share of the rows."""
    newest_first = Window.orderBy(F.desc("date"))
    everything = Window.partitionBy()
    held = (
        train.groupBy("date")
        .agg(F.count("*").alias("_n"))
        .select(
            "date",
            F.sum("_n").over(newest_first.rowsBetween(Window.unboundedPreceding, 0)).alias("_after"),
            F.sum("_n").over(everything).alias("_all"),
        )
        .select("date", (F.col("_after") <= F.floor(F.col("_all") * share)).alias("is_validation"))
    )
    return train.join(held, "date")


def feature_matrix(features: DataFrame, columns: list[str] = FEATURE_COLS) -> DataFrame:
    """The model columns as doubles with zero for missing, next to the row's identity and target."""
    filled = {c: F.coalesce(dbl(c), F.lit(0.0)) for c in columns}
    identity = ["date", "division_code", "division_name", "day_of_week", "event_flag", "sales_amt", "is_test"]
    keep = [c for c in identity if c in features.columns]
    return features.select(*keep, *[v.alias(f"x_{c}") for c, v in filled.items()])


def assemble(matrix: DataFrame, columns: list[str] = FEATURE_COLS) -> DataFrame:
    return VectorAssembler(inputCols=[f"x_{c}" for c in columns], outputCol="features").transform(matrix)
