"""Retail tables derived from a star schema of orders and order lines.

Brands act as divisions, parts as SKUs, orders as baskets and lines as basket lines.
"""

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.numeric import MONEY, big, dbl, fixed, money, ratio
from tillwise.sources.store import Store

_TABLES = ["customer", "events", "lineitem", "nation", "orders", "part"]
# Decimal steps of the stand-in margin and basket-size curves.
PER_MILLE = Decimal("0.001")
DEPARTMENTS = ["Women", "Men", "Kids", "Others"]
AGE_BANDS = ["18-24", "25-34", "35-44", "45-54", "55+"]
GENDERS = ["F", "M", "unspecified"]


# Units of the whole-number arithmetic below.
CENT = Decimal("0.01")
NET_UNIT = Decimal("0.0001")  # cents times discount percent
MARGIN_UNIT = Decimal("0.0000005")  # net units times half-percent margin steps


def pick(values: list[str], index) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index + 1)


def cents(col: str | Column) -> Column:
    """Whole cents of a double amount. Integers multiply and add several times faster than decimals."""
    amount = F.col(col) if isinstance(col, str) else col
    return F.rint(amount * 100).cast("bigint")


def dollars(units, unit: Decimal = CENT) -> Column:
    """Whole units as an exact two-place amount."""
    exact = (F.col(units) if isinstance(units, str) else units).cast("decimal(20,0)") * F.lit(unit)
    return (exact if unit == CENT else F.round(exact, 2)).cast(MONEY)


def division_code(name="division_name") -> Column:
    return F.substring(name, 7, 9).cast("int")


def department(name="division_name") -> Column:
    return pick(DEPARTMENTS, division_code(name) % 4)


class StarStore(Store):
    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def input_paths(self) -> list[str]:
        return [f"{self.directory}/{table}.parquet" for table in _TABLES]

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{table}.parquet")

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("sku_id"),
            division_code("p_brand").alias("division_code"),
            F.col("p_brand").alias("division_name"),
            department("p_brand").alias("department"),
            F.col("p_name").alias("product_name"),
            F.when(size <= 12, "Entry").when(size <= 25, "Core").when(size <= 38, "Mid")
            .otherwise("Premium").alias("price_tier"),
            money("p_retailprice").alias("unit_price"),
            F.col("p_type").alias("season"),
            ((400 + 5 * size).cast("decimal(4,0)") * F.lit(PER_MILLE)).alias("gp_ratio"),
            (division_code("p_brand") % 10 == 1).alias("is_cold_snap_sensitive"),
            F.lit("1995-01-01").cast("date").alias("launch_date"),
            F.lit(True).alias("is_active"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with their product attributes.

        Amounts are whole numbers: `net` is price after discount in net units, and `net`
        times `margin_steps` is the margin in margin units. The largest group sum they feed
        (a day of a division that holds a third of 100 TB) stays within a bigint.

        The product side is broadcast only while Spark's size threshold allows it; beyond
        that this is a sort-merge join whose hot SKUs adaptive execution splits.
        """
        off = F.rint(F.col("l_discount") * 100).cast("int")
        fact = self.raw("lineitem").select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            off.alias("discount_pct"),
            F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5).alias("unit_cents"),
            (cents("l_extendedprice") * (100 - off)).alias("net"),
        )
        product = self.raw("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_brand").alias("division_name"),
            (80 + F.col("p_size")).alias("margin_steps"),
        )
        return fact.join(product, "sku_id")

    @cached_property
    def transaction_items(self) -> DataFrame:
        discounted = F.floor((F.col("unit_cents") * (100 - F.col("discount_pct")) + 50) / 100)
        return self.lines.select(
            "transaction_id", "sku_id", division_code().alias("division_code"), "date", "quantity",
            dollars("unit_cents").cast("decimal(12,2)").alias("unit_price"),
            dollars(discounted).cast("decimal(12,2)").alias("discounted_price"),
            dollars(F.col("net") * F.col("margin_steps"), MARGIN_UNIT).alias("gross_profit_amt"),
        )

    @cached_property
    def dated_items(self) -> DataFrame:
        """Lines carry their own date, so no join is needed."""
        return self.transaction_items

    @cached_property
    def item_dates(self) -> DataFrame:
        return self.raw("lineitem").select(F.col("l_shipdate").cast("date").alias("date"))

    @cached_property
    def promo_lines(self) -> DataFrame:
        return self.lines.select(
            "transaction_id", "sku_id", "quantity",
            dollars("unit_cents").cast("decimal(12,2)").alias("unit_price"),
            ((F.col("margin_steps") * 5).cast("decimal(4,0)") * F.lit(PER_MILLE)).alias("gp_ratio"),
            (F.col("discount_pct") > 0).alias("promo"),
        )

    @cached_property
    def visits(self) -> DataFrame:
        return self.raw("events").select("ts")

    @cached_property
    def division_daily(self) -> DataFrame:
        sums = self.lines.groupBy("date", "division_name").agg(
            F.sum("net").alias("net"),
            F.sum(F.col("net") * F.col("margin_steps")).alias("margin"),
            F.countDistinct("transaction_id").alias("num_transactions"),
        )
        return sums.select(
            "date", division_code().alias("division_code"), "division_name", department().alias("department"),
            dollars("net", NET_UNIT).alias("sales_amt"),
            dollars("margin", MARGIN_UNIT).alias("gp_amt"),
            fixed(ratio(dollars("margin", MARGIN_UNIT), dollars("net", NET_UNIT)), 4).alias("gp_ratio"),
            "num_transactions",
        )

    @cached_property
    def daily_sales(self) -> DataFrame:
        """One row per trading day. The windows below run over days, never over orders."""
        by_day = (
            self.raw("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("date"))
            .agg(
                dollars(F.sum(cents("o_totalprice"))).alias("actual_sales"),
                F.countDistinct("o_custkey").alias("num_customers"),
            )
        )
        doy = F.dayofyear("date")
        same_weekday = Window.partitionBy("day_of_week")
        year_ago = Window.orderBy(F.unix_date("date")).rangeBetween(-364, -364)
        gp_ratio = ((F.lit(590) + doy % 61).cast("decimal(4,0)") * F.lit(PER_MILLE)).cast("decimal(9,4)")
        avg_qty = ((F.lit(210) + doy % 41).cast("decimal(4,0)") * F.lit(Decimal("0.01"))).cast(MONEY)
        staged = (
            by_day.withColumns(
                {
                    "day_of_week": cal.day_name("date"),
                    "temperature_index": cal.seasonal_temperature("date"),
                    "gross_profit_ratio": gp_ratio,
                    "avg_qty": avg_qty,
                    "avg_spend": fixed(ratio("actual_sales", "num_customers"), 2),
                    "_year_ago": F.first("actual_sales").over(year_ago),
                }
            )
            .withColumn("event_flag", cal.event_flag("date", "temperature_index"))
            .withColumn(
                "target",
                fixed(dbl(F.sum("actual_sales").over(same_weekday)) / F.count("*").over(same_weekday), 2),
            )
        )
        return staged.select(
            "date", "day_of_week",
            cal.trading_hours("day_of_week").alias("trading_hours"),
            cal.is_holiday("date").alias("is_public_holiday"),
            "event_flag", "temperature_index", "target", "actual_sales",
            fixed(ratio("actual_sales", "target"), 4).alias("achievement_pct"),
            "num_customers", "avg_spend", "avg_qty",
            fixed(ratio("avg_spend", "avg_qty"), 2).alias("avg_unit_price"),
            F.round(F.col("actual_sales") * F.col("gross_profit_ratio"), 2).cast(MONEY).alias("gross_profit_amt"),
            "gross_profit_ratio",
            fixed(ratio(F.col("actual_sales") - F.col("_year_ago"), "_year_ago"), 4).alias("yoy_pct"),
            ((F.col("event_flag") == cal.NO_EVENT) & (F.dayofmonth("date") % 8 == 0)).alias("promo_flag"),
        )

    @cached_property
    def baskets(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_custkey").alias("customer_id"),
            dollars(cents("o_totalprice")).alias("total_amount"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """Baskets: orders with their line totals.

        The line totals hang on by a left join to a frame unique per basket, so a query
        that needs no line column never reads the lines.
        """
        per_basket = self.lines.groupBy("transaction_id").agg(
            F.sum("quantity").alias("num_items"),
            dollars(F.sum(F.col("net") * F.col("margin_steps")), MARGIN_UNIT).alias("gross_profit"),
            F.max(F.col("discount_pct") > 0).alias("promo_applied"),
        )
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_orderdate").alias("timestamp"),
            F.col("o_custkey").alias("customer_id"),
            dollars(cents("o_totalprice")).alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
        )
        types = self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_type")
        )
        return (
            orders.join(types, "customer_id")
            .join(per_basket, "transaction_id", "left")
            .select(
                "transaction_id", "date", "timestamp", "customer_id", "customer_type",
                F.coalesce("num_items", F.lit(0).cast("bigint")).alias("num_items"),
                "total_amount",
                F.coalesce("gross_profit", F.lit(0).cast(MONEY)).alias("gross_profit"),
                "payment_method",
                F.coalesce("promo_applied", F.lit(False)).alias("promo_applied"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        nations = self.raw("nation").select("n_nationkey", F.col("n_name").alias("nationality"))
        visits = (
            self.raw("orders")
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(
                F.count("*").alias("total_visits"),
                dollars(F.sum(cents("o_totalprice"))).alias("total_spend"),
                F.min(F.col("o_orderdate").cast("date")).alias("join_date"),
                F.max(F.col("o_orderdate").cast("date")).alias("last_visit_date"),
            )
        )
        people = self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("customer_type"),
            "c_nationkey",
            pick(AGE_BANDS, (F.col("c_custkey") % 5).cast("int")).alias("age_band"),
            pick(GENDERS, (F.col("c_custkey") % 3).cast("int")).alias("gender"),
        )
        return (
            people.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(visits, "customer_id", "left")
            .select(
                "customer_id", "customer_type", "join_date", "nationality", "age_band", "gender",
                big(F.coalesce("total_visits", F.lit(0))).alias("total_visits"),
                F.coalesce("total_spend", F.lit(0).cast(MONEY)).alias("total_spend"),
                fixed(ratio("total_spend", "total_visits"), 2).alias("avg_spend_per_visit"),
                "last_visit_date",
            )
        )
