"""Weekly stock ledger per SKU."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numeric import dbl, rnd
from tillwise.operators.prep import dealt, week_range

# Weekly velocity by price tier, opening cover and top-up in weeks.
VELOCITY = {"Entry": 27, "Core": 16, "Mid": 7, "Premium": 3}
OPENING_WEEKS = 15
TOP_UP_WEEKS = 6
REORDER_BELOW_WEEKS = 4


def weeks_sold(units: DataFrame) -> DataFrame:
    """The weeks that a SKU sold in and the units of each, as two arrays in one row, at most as long as there are weeks."""
    return units.where(F.col("week_start").isNotNull()).groupBy("sku_id").agg(
        F.collect_list("week_start").alias("sold_in"),
        F.collect_list(F.coalesce("units_sold", F.lit(0)).cast("bigint")).alias("sold"),
    )


def stock_ledger(units: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Running stock per SKU and week with replenishment below four weeks of cover."""
    return ledger_of(weeks_sold(units), products, dates)


def ledger_of(sold: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """The ledger from the weeks that each SKU sold in.

    Each week depends on the one before, so a SKU's weeks are folded in order. They come
    as one array per SKU, whose length is the number of weeks; the fold steps through the
    weeks for a whole batch of SKUs at once and returns arrays, which are spread over the weeks last.
    So rows stay where their SKU is, and a query that needs no stock runs no fold.
    """
    velocity = F.lit(10)
    for tier, weekly in VELOCITY.items():
        velocity = F.when(F.col("price_tier") == tier, weekly).otherwise(velocity)
    known = products.select("sku_id", velocity.alias("velocity"))
    fold = F.arrow_udf(_fold_weeks, "struct<opening: array<bigint>, received: array<bigint>, closing: array<bigint>>")
    # a SKU and its weeks meet in one shuffle, to which either gives one row
    per_sku = (
        dealt(known.unionByName(sold, allowMissingColumns=True))
        .groupBy("sku_id")
        .agg(F.max("velocity").alias("velocity"), *[F.first(c, ignorenulls=True).alias(c) for c in ("sold_in", "sold")])
        .withColumn("sold", F.map_from_arrays("sold_in", "sold"))
        .where(F.col("velocity").isNotNull())
        .withColumn("weeks", week_range(dates))
        .withColumn("units", F.transform("weeks", lambda w: F.coalesce(F.col("sold")[w], F.lit(0).cast("bigint"))))
        .withColumn("stock", fold("units", "velocity"))
    )
    spread = per_sku.select("sku_id", "velocity", "units", "stock", F.posexplode("weeks").alias("week", "week_start_date"))
    of_week = lambda c: F.get(c, F.col("week"))
    ledger = spread.select(
        "week_start_date", "sku_id", "velocity", of_week("stock.opening").alias("opening_stock"), of_week("units").alias("units_sold"),
        of_week("stock.received").alias("units_received"), of_week("stock.closing").alias("closing_stock"),
    )
    return ledger.select(
        "week_start_date", "sku_id", "opening_stock", "units_sold", "units_received", "closing_stock",
        ((F.col("closing_stock") == 0) & (F.col("units_sold") > 0)).alias("oos_flag"),
        rnd(dbl("closing_stock") / F.col("velocity"), 2).alias("weeks_of_cover"),
    )


def _fold_weeks(units: pa.Array, velocities: pa.Array) -> pa.Array:
    """Opening stock, receipts and closing stock of each week, from the weeks' units; all arrays are as long."""
    velocity = velocities.to_numpy(zero_copy_only=False).astype(np.int64)
    sold = units.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(units), -1) if len(units) else np.zeros((0, 0), np.int64)
    weeks = sold.shape[1]
    opening, received, closing = (np.empty((weeks, len(sold)), np.int64) for _ in range(3))
    stock = velocity * OPENING_WEEKS
    for week in range(weeks):
        opening[week] = stock
        received[week] = np.where(stock < REORDER_BELOW_WEEKS * velocity, velocity * TOP_UP_WEEKS, 0)
        stock = np.maximum(0, stock + received[week] - sold[:, week])
        closing[week] = stock
    offsets = pa.array(np.arange(len(sold) + 1, dtype=np.int32) * weeks)
    arrays = [pa.ListArray.from_arrays(offsets, np.ascontiguousarray(x.T).ravel()) for x in (opening, received, closing)]
    return pa.StructArray.from_arrays(arrays, ["opening", "received", "closing"])
