"""Boosted trees against plain loops: splits, quantile leaves, stopping, Shapley values, blocks."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.operators.boosting import SMOOTHING, Trees, _Grower, bin_edges, fit_trees, with_contributions, with_forecast
from tillwise.settings import Boosting, Settings
from tillwise.sources.scratch import durable

COLUMNS = ["a", "b", "c", "d"]


def sample(n: int = 600, seed: int = 3):
    rng = np.random.default_rng(seed)
    x = np.column_stack((rng.normal(size=n), rng.integers(0, 4, n), rng.normal(size=n), rng.integers(0, 2, n))).astype(float)
    return x, 3 * x[:, 0] + 2 * (x[:, 1] > 1) * x[:, 3] + rng.normal(scale=0.3, size=n)


def grower(plan: Boosting, x, y, held=None):
    edges = [bin_edges(c) for c in x.T]
    bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)])
    return _Grower(plan, edges, bins, y, np.zeros(len(y), bool) if held is None else held, np.arange(len(y), dtype=np.uint64))


@pytest.fixture(scope="module")
def frame(spark):
    x, y = sample()
    rows = [(i, i % 5, float(t), i % 7 == 0, *map(float, r)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "day int, division int, y double, is_validation boolean, a double, b double, c double, d double")


def test_every_split_is_the_best_one():
    x, y = sample(80)
    g = grower(Boosting(1, 3, 1.0), x, y)
    nodes = {int(n[0]): n for n in g.tree(0)}
    resid = y - y.mean()

    def worth(mask):
        return resid[mask].sum() ** 2 / (mask.sum() + SMOOTHING)

    def visit(node, mask):
        _, feature, threshold, value, cover = nodes[node]
        assert cover == mask.sum() and value == pytest.approx(resid[mask].sum() / (mask.sum() + SMOOTHING))
        gains = [worth(mask & (x[:, f] <= t)) + worth(mask & (x[:, f] > t)) - worth(mask) for f in range(4) for t in np.unique(x[mask, f])[:-1]]
        if feature < 0:
            assert node >= 8 or not gains or max(gains) < 1e-6
            return
        left = mask & (x[:, int(feature)] <= threshold)
        assert worth(left) + worth(mask & ~left) - worth(mask) == pytest.approx(max(gains))
        visit(2 * node, left)
        visit(2 * node + 1, mask & ~left)

    visit(1, np.ones(80, bool))


def test_leaves_of_quantile_trees_hold_their_quantile():
    x, y = sample(300)
    for share in (0.15, 0.85):
        g = grower(Boosting(1, 2, 1.0, quantile=share), x, y)
        start = g.forecast.copy()
        g.tree(0)
        for step in np.unique(np.round(g.forecast - start, 9)):
            leaf = np.round(g.forecast - start, 9) == step
            assert step == pytest.approx(np.quantile((y - start)[leaf], share), abs=1e-6)
        assert start[0] == np.quantile(y, share)


def test_growth_stops_by_patience_and_keeps_the_best():
    x, y = sample(200)
    held = np.arange(200) % 4 == 0
    errors = []
    g = grower(Boosting(400, 6, 0.3, patience=5), x, y, held)
    whole = g.tree

    def watched(number):
        out = whole(number)
        errors.append(((y - g.forecast)[held] ** 2).mean())
        return out

    g.tree = watched
    kept = g.grow()
    assert len(kept) == int(np.argmin(errors)) + 1 and len(errors) == len(kept) + 5 < 400


def test_columns_and_rows_are_sampled():
    x, y = sample()
    one = [{int(f) for f in t[:, 1] if f >= 0} for t in grower(Boosting(30, 6, 0.1, column_share=0.5), x, y).grow()]
    assert all(len(f) <= 2 for f in one) and set().union(*one) == {0, 1, 2, 3}
    covers = [t[0, 4] / 600 for t in grower(Boosting(30, 2, 0.1, row_share=0.8), x, y).grow()]
    assert 0.7 < min(covers) < max(covers) < 0.9 and np.mean(covers) == pytest.approx(0.8, abs=0.02)


def test_models_of_the_store_are_of_full_size():
    point = Settings().models["point"]
    assert (point.trees, point.depth, point.rate, point.row_share, point.column_share, point.patience) == (500, 6, 0.05, 0.8, 0.8, 20)
    assert [(p.trees, p.depth, p.rate, p.quantile) for k, p in Settings().models.items() if k != "point"] == [(400, 5, 0.05, 0.15), (400, 5, 0.05, 0.85)]


def test_contributions_are_shapley_values(spark, frame):
    table = durable(fit_trees(frame, COLUMNS, "y", {"p": Boosting(5, 4, 0.3, column_share=0.8, patience=50)}, ["day"], "division"))
    trees = Trees(table.toArrow())
    x, _ = sample()
    x = x[:6]

    def mean_given(tree, row, known):
        def visit(node):
            f = int(trees.feature[tree, node])
            if f < 0:
                return trees.value[tree, node]
            if f in known:
                return visit(2 * node + (row[f] > trees.threshold[tree, node]))
            parts = [trees.cover[tree, 2 * node + k] / trees.cover[tree, node] for k in (0, 1)]
            return sum(w * visit(2 * node + k) for k, w in enumerate(parts))

        return visit(1)

    def plain(row, i):
        total = 0.0
        for size in range(4):
            for known in combinations([j for j in range(4) if j != i], size):
                weight = factorial(size) * factorial(3 - size) / factorial(4)
                total += weight * sum(mean_given(t, row, {*known, i}) - mean_given(t, row, known) for t in range(len(trees.feature)))
        return total

    got = trees.contributions(x)
    assert got == pytest.approx(np.array([[plain(r, i) for i in range(4)] for r in x]))
    both = with_forecast(with_contributions(frame, table, COLUMNS, "division", F.lit("p"), [f"of_{c}" for c in COLUMNS]), table, COLUMNS, "division", F.lit("p"))
    off = both.agg(F.max(F.abs(F.col("base") + sum(F.col(f"of_{c}") for c in COLUMNS) - F.col("yhat"))), F.count("*")).first()
    assert off[0] < 1e-9 and off[1] == 600


def test_bounds_cover_their_share_and_differ_within_a_division(frame):
    plans = {"low": Boosting(200, 3, 0.05, quantile=0.15), "high": Boosting(200, 3, 0.05, quantile=0.85)}
    table = durable(fit_trees(frame.where("day % 2 = 0"), COLUMNS, "y", plans, ["day"], "division"))
    rows = frame.where("day % 2 = 1")
    for name in plans:
        rows = with_forecast(rows, table, COLUMNS, "division", F.lit(name), name)
    inside, widths = rows.agg(F.avg(F.col("y").between(F.col("low"), F.col("high")).cast("int")), F.count_distinct(F.round("low", 6), "division")).first()
    assert 0.55 <= inside <= 0.8 and widths > 50


def test_blocks_hold_whole_divisions_and_empty_tables_give_nothing(spark, frame):
    plan = {"p": Boosting(3, 3, 0.3)}
    table = durable(fit_trees(frame, COLUMNS, "y", plan, ["day"], "division", rows_per_block=250))
    assert table.select("blocks").distinct().collect()[0][0] == 3
    roots = table.where("tree = 0 AND node = 1").agg(F.sum("cover")).first()[0]
    assert roots == 600
    assert with_forecast(frame, table, COLUMNS, "division", F.lit("p")).where("yhat IS NOT NULL").count() == 600
    assert fit_trees(frame.limit(0), COLUMNS, "y", plan, ["day"], "division").count() == 0
    assert with_forecast(frame, table.limit(0), COLUMNS, "division", F.lit("p")).count() == 0


def test_only_limits_what_a_plan_sees(frame):
    plans = {"early": Boosting(1, 1, 1.0), "all": Boosting(1, 1, 1.0)}
    table = fit_trees(frame, COLUMNS, "y", plans, ["day"], "division", {"early": F.col("day") < 100})
    covers = {r.plan: r.cover for r in table.where("tree = 0 AND node = 1").collect()}
    assert covers == {"early": 100.0, "all": 600.0}
