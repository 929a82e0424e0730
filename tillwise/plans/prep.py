"""Preparation queries over a store."""

from pyspark.sql import functions as F

from tillwise.operators import prep, stock
from tillwise.sources.scratch import durable
from tillwise.sources.star import pick


def marketing_segments(s):
    """Customers with their marketing segment; where a store has none, one spread evenly over the four kinds."""
    if "segment" in s.customers.columns:
        return s.customers.select("customer_id", "segment")
    text = dict(s.customers.dtypes)["customer_id"] == "string"
    number = F.crc32("customer_id") if text else F.col("customer_id")
    segment = pick(list(prep.CUSTOMER_SEGMENTS), (number % 4).cast("int"))
    return s.customers.select("customer_id", segment.alias("segment"))


def units(s):
    return prep.weekly_units(s.dated_items)


def inventory(s, settled: bool = False):
    """The inventory that the store holds, else a ledger made from the units sold.

    Settled, the weeks sold are written first, so that what the lines were shuffled for need not stay while the ledger is spread.
    """
    found = s.stored("inventory")
    if found is not None:
        return found
    sold = stock.weeks_sold(units(s))
    return stock.ledger_of(durable(sold) if settled else sold, s.products, s.item_dates)


PLANS = {
    "prep_event_calendar": lambda s: prep.event_calendar(s.daily_sales),
    "prep_holiday_flag": lambda s: prep.holiday_flag(s.daily_sales),
    "prep_trading_hours": lambda s: prep.opening_hours(s.daily_sales),
    "prep_daily_ratios": lambda s: prep.daily_ratios(s.daily_sales),
    "prep_yoy_364": lambda s: prep.yoy_same_weekday(s.sales_days),
    "prep_division_weight": lambda s: prep.division_weights(s.daily_sales, s.products),
    "prep_proportional_allocation": lambda s: prep.allocate(s.daily_sales, s.products),
    "prep_customer_type": lambda s: prep.customer_type(marketing_segments(s)),
    "prep_line_price": lambda s: prep.line_price(s.promo_lines),
    "prep_basket_rollup": lambda s: prep.basket_rollup(s.transaction_items),
    "prep_items_with_date": lambda s: prep.items_with_date(s.transaction_items, s.baskets),
    "prep_week_floor": lambda s: prep.week_floor(s.daily_sales),
    "prep_weekly_units": units,
    "prep_week_spine": lambda s: prep.week_spine(units(s), s.products, s.item_dates),
    "prep_stock_ledger": inventory,
    "prep_hour_profile": lambda s: prep.hour_profile(s.visits),
}
