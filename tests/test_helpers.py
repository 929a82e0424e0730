"""Distributed helpers against plain loops and direct solutions."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.operators import features as feat
from tillwise.operators import forecast as fc
from tillwise.operators import segments
from tillwise.operators.order_stats import ntile_score, quartiles, rows_at
from tillwise.plans.features import joined
from tillwise.plans.forecast import matrices, trees
from tillwise.settings import Boosting
from tillwise.sources.scratch import durable


def plain_ntile(rows, k):
    n, out, i = len(rows), {}, 0
    for tile in range(k):
        for _ in range(n // k + (tile < n % k)):
            out[rows[i][1]] = tile + 1
            i += 1
    return out


@pytest.mark.parametrize("n, kinds", [(10, 3), (3, 2), (257, 1), (1000, 5), (0, 1)])
def test_ntile_matches_a_loop(spark, n, kinds):
    """Few distinct values: one of them holds a third of the rows or more."""
    rng = random.Random(n)
    rows = [(rng.randrange(kinds), i) for i in range(n)]
    df = spark.createDataFrame(rows, "v int, id bigint").repartition(7)
    for descending in (False, True):
        scored = df.withColumn("t", ntile_score(df, "v", "id", 4, descending))
        want = plain_ntile(sorted(rows, key=lambda r: (-r[0] if descending else r[0], r[1])), 4)
        assert {r.id: r.t for r in scored.collect()} == want


def test_positions_and_quartiles(spark):
    rng = random.Random(5)
    values = [rng.choice([1.5, 1.5, 2.25, rng.random() * 9]) for _ in range(331)]
    df = spark.createDataFrame(list(zip(values, range(331))), "v double, id bigint").repartition(5)
    ordered = sorted(zip(values, range(331)))
    got = rows_at(df, [("v", True), ("id", True)], lambda n: [0, n // 2, n - 1])
    assert [(r.v, r.id) for r in got] == [ordered[0], ordered[165], ordered[330]]
    assert quartiles(df, "v", "id") == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]).tolist())


def test_sample_is_the_same_on_any_partitioning(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = {r.k for r in segments.sample_rows(df, "k", 500, 42).collect()}
    b = {r.k for r in segments.sample_rows(df.repartition(13), "k", 500, 42).collect()}
    assert len(a) == 500 and a == b and a != {r.k for r in segments.sample_rows(df, "k", 500, 7).collect()}


def test_crosstab_rows_sum_to_hundred(spark):
    df = spark.createDataFrame([(i % 3, "abc"[i % 2]) for i in range(50)], "cluster int, kind string")
    wide = segments.crosstab_share(df, "cluster", "kind", ["a", "b", "c"])
    assert all(sum(r[k] for k in "abc") == pytest.approx(100, abs=0.001) for r in wide.collect())
    assert segments.melt(wide, "cluster", "kind").count() == 9


def test_seasonal_regression_equals_direct_least_squares(store):
    labelled = feat.label_split(joined(store)).where(F.col("division_code") == 3)
    rows = labelled.select("is_test", F.col("sales_amt").cast("double").alias("y"), fc.seasonal_terms().alias("x"), "date").orderBy("date").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    train = np.array([not r.is_test for r in rows])
    want = x @ np.linalg.lstsq(
        np.vstack([x[train], np.sqrt(fc.RIDGE) * np.eye(x.shape[1])]), np.concatenate([y[train], np.zeros(x.shape[1])]), rcond=None)[0]
    got = [r.yhat for r in fc.seasonal_regression(labelled).orderBy("date").collect()]
    assert got == pytest.approx(want[~train].tolist(), rel=1e-6, abs=1e-3)


def test_ar_baseline_equals_a_direct_roll_forward(spark):
    rng = np.random.default_rng(3)
    series = np.cumsum(rng.normal(0, 5, 200)) + 500
    start = date(2024, 1, 1)
    rows = [(start + timedelta(i), 1, float(v), i >= 190) for i, v in enumerate(series)]
    df = spark.createDataFrame(rows, "date date, division_code int, sales_amt double, is_test boolean")
    steps = np.diff(series[:190])
    x = np.array([steps[i : i + 7] for i in range(len(steps) - 7)])
    w = np.linalg.solve(x.T @ x + fc.RIDGE * np.eye(7), x.T @ steps[7:])
    tail, level, want = list(steps[-7:]), series[189], []
    for _ in range(10):
        tail.append(float(w @ np.array(tail[-7:])))
        level += tail[-1]
        want.append(level)
    assert [r.yhat for r in fc.ar_baseline(df).orderBy("date").collect()] == pytest.approx(want)


def test_walk_forward_regression_equals_refits(spark):
    rng = np.random.default_rng(1)
    names = feat.FEATURE_COLS
    start, n = date(2024, 1, 1), 60
    x = rng.random((n, len(names)))
    y = x @ rng.random(len(names)) * 10 + rng.normal(0, 0.1, n)
    rows = [(start + timedelta(i), 1, "Monday", "None", float(round(y[i], 2)), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(
        rows, "date date, division_code int, day_of_week string, event_flag string, sales_amt double, " + ", ".join(f"x_{c} double" for c in names)
    ).withColumn("sales_amt", F.col("sales_amt").cast("decimal(18,2)"))
    got = {r.date: float(r.predicted_sales) for r in fc.walk_forward_least_squares(df).collect()}
    keep = [i for i, c in enumerate(names) if c != "division_code"]
    design = np.hstack([np.ones((n, 1)), x[:, keep]])
    target = np.round(y, 2)
    for i in range(40, n):
        scale = np.abs(design[:i]).max(axis=0)
        past = design[:i] / scale
        a = past.T @ past + fc.RIDGE * np.eye(design.shape[1])
        want = design[i] / scale @ np.linalg.solve(a, past.T @ target[:i])
        assert got[start + timedelta(i)] == pytest.approx(want, abs=0.006)
    assert len(got) == n - design.shape[1]
    last = start + timedelta(n - 1)
    changed = df.withColumns({f"x_{c}": F.when(F.col("date") == last, F.lit(500.0)).otherwise(F.col(f"x_{c}")) for c in names})
    later = {r.date: float(r.predicted_sales) for r in fc.walk_forward_least_squares(changed).collect()}
    assert {d: v for d, v in later.items() if d < last} == {d: v for d, v in got.items() if d < last}


def test_contributions_add_up_to_the_forecast(store):
    train, test = matrices(store)
    model = fc.fit_linear(train)
    parts = fc.contributions(model, train, test)
    summed = parts.groupBy("date", "division_code").agg((F.first("base") + F.sum("contribution")).alias("total"))
    gap = summed.join(fc.predict(model, test), ["date", "division_code"]).agg(F.max(F.abs(F.col("total") - F.col("yhat"))), F.count("*")).first()
    assert gap[0] < 1e-5 and gap[1] == test.count()
    top = fc.top_drivers(parts).groupBy("date", "division_code").count()
    assert {r["count"] for r in top.collect()} == {8}


def test_boosted_trees_beat_the_mean(store):
    train, test = (durable(m) for m in matrices(store))
    scored = fc.tree_forecast(train, trees(store), {"point": "yhat"})
    mean = train.agg(F.avg(F.col("sales_amt").cast("double"))).first()[0]
    y = F.col("sales_amt").cast("double")
    model, naive = scored.agg(F.avg((y - F.col("yhat")) ** 2), F.avg((y - mean) ** 2)).first()
    assert model < naive


def test_bounds_are_ordered_and_near_target_on_training_days(store):
    train, _ = feat.temporal_split(joined(store))
    fitted = fc.weekday_mean_forecast(train, train)
    bounded = fc.residual_bounds(fitted, fitted)
    assert bounded.where(F.col("lower") > F.col("upper")).count() == 0
    assert fc.coverage(bounded).first().coverage >= 0.69


def test_boosted_walk_forward_covers_every_later_day_once(store):
    rows = joined(store).where(F.col("date") < "1996-06-01")
    matrix = durable(feat.feature_matrix(feat.build_features(rows)))
    few = {"point": Boosting(2, 3, 0.1), "lower": Boosting(2, 3, 0.1, quantile=0.15), "upper": Boosting(2, 3, 0.1, quantile=0.85)}
    log = fc.walk_forward_boosted(matrix, warm_up_weeks=26, every_weeks=20, models=few)
    start = matrix.agg(F.min("date")).first()[0] + timedelta(weeks=26)
    assert log.count() == matrix.where(F.col("date") >= F.lit(start)).count()
    assert log.select("date", "division_code").distinct().count() == log.count()
    assert log.where(F.col("predicted_sales").isNull()).count() == 0
