"""The spine of SKUs and weeks: no row of it is shuffled, and the checks of its key stay where the SKUs are."""

import re

from pyspark.sql import functions as F

from tillwise.operators import contract, prep, stock
from tillwise.plans.prep import units


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def generated_below_shuffles(plan: str) -> bool:
    """Whether an exchange stands above the generator of weeks: the lines of a plan go from the top down, deeper by indentation."""
    depth = lambda line: len(re.match(r"[\s:|+*()\d-]*", line).group())
    lines = plan.split("Initial Plan")[-1].splitlines()
    at = next(i for i, line in enumerate(lines) if "Generate explode" in line or "Generate posexplode" in line)
    return any("Exchange hashpartitioning" in line and depth(line) < depth(lines[at]) for line in lines[:at])


def test_spine_is_not_shuffled(store):
    spine = prep.week_spine(units(store), store.products, store.item_dates)
    plan = spine._jdf.queryExecution().executedPlan().toString()
    assert not generated_below_shuffles(plan)


def test_key_of_the_ledger_is_checked_in_place(store):
    ledger = stock.stock_ledger(units(store), store.products, store.item_dates)
    twice = ledger.groupBy("week_start_date", "sku_id").count().where(F.col("count") > 1)
    plan = twice._jdf.queryExecution().executedPlan().toString()
    assert not generated_below_shuffles(plan) and "ArrowEvalPython" not in plan
    assert twice.count() == 0
    again = contract.check_contract({"inventory": ledger.unionByName(ledger.limit(3))})
    assert again.where(F.col("check_name").startswith("key")).first().violations == 3


def test_repeated_and_unsold_skus_keep_their_weeks(spark):
    products = spark.createDataFrame([(1,), (2,), (2,), (None,)], "sku_id int")
    sold = spark.createDataFrame([("2024-01-03", 1, 4), ("2024-01-16", 1, 5), ("2024-01-16", 9, 7)], "date string, sku_id int, quantity int")
    sold = sold.withColumn("date", F.col("date").cast("date"))
    out = sorted((r.sku_id or 0, str(r.week_start), r.units_sold) for r in prep.week_spine(prep.weekly_units(sold), products, sold.select("date")).collect())
    weeks = ["2024-01-01", "2024-01-08", "2024-01-15"]
    assert out == sorted([(1, w, u) for w, u in zip(weeks, (4, 0, 5))] + [(k, w, 0) for k in (0, 2, 2) for w in weeks])
