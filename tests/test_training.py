"""Training everything and reading it back."""

import pytest
from pyspark.sql import functions as F

from tillwise.functions.calendar import DAYS_OF_WEEK
from tillwise.operators import forecast as fc
from tillwise.operators.boosting import TREE_SCHEMA
from tillwise.plans.forecast import matrices
from tillwise.plans.registry import all_plans
from tillwise.plans.training import load_all, train_all
from tillwise.sources.scratch import scratch_path
from tillwise.sources.store import FileStore, save_store


def test_train_and_load(spark, store):
    path = scratch_path(spark, "trained")
    assert load_all(spark, path) == {}
    train_all(store, path)
    found = load_all(spark, path)
    assert set(found) == {
        "trees", "driver_model", "error_bounds", "test_metrics", "accuracy_lookup", "forecast_log", "bias_flags"
    }
    assert found["error_bounds"].where(F.col("low_error") > F.col("high_error")).count() == 0
    assert found["forecast_log"].count() > 0 and found["test_metrics"].first().rmse > 0
    _, test = matrices(store)
    assert fc.tree_forecast(test, found["trees"], {"point": "yhat"}).count() == test.count()


def test_stored_trees_answer_scenarios(spark, store):
    """Trees planted in a store's folder are what its scenarios are answered from."""
    path = scratch_path(spark, "store")
    save_store(store, path)
    planted = [("point", 0, 1, -1, 1, -1, 0.0, 7.0, 0.0), ("point", 0, 1, 0, 1, 7, 0.0, 0.0, 2.0), ("point", 0, 1, 0, 2, -1, 0.0, -9.0, 1.0), ("point", 0, 1, 0, 3, -1, 0.0, 3.0, 1.0)]
    spark.createDataFrame(planted, TREE_SCHEMA).write.parquet(f"{path}/models/trees")
    answers = all_plans()["dash_scenario_forecast"](FileStore(spark, path))
    # the middle of every month is beyond day 0: 7 + 3, and the fixed band without quantile models
    assert answers.agg(F.min("predicted"), F.max("predicted"), F.min("lower"), F.max("upper")).first()[:] == pytest.approx((10.0, 10.0, 8.8, 11.2))
    weekdays = spark.createDataFrame([(*r[:5], 5, 2.0, *r[7:]) if r[4] == 1 and r[3] == 0 else r for r in planted], TREE_SCHEMA)
    weekdays.write.mode("overwrite").parquet(f"{path}/models/trees")
    by_day = {(r.day_of_week, r.predicted) for r in all_plans()["dash_scenario_forecast"](FileStore(spark, path)).collect()}
    assert by_day == {(d, 0.0 if i < 3 else 10.0) for i, d in enumerate(DAYS_OF_WEEK)}
