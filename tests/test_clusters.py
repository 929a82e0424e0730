"""K-means fits that share their passes, against Spark's own K-means fit by fit."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator

from tillwise.operators import segments as seg

XY = ["x", "y"]


def table(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id bigint, x double, y double").coalesce(1)


def jobs_so_far(spark) -> int:
    """The number of a job of our own tells how many ran before it."""
    sc = spark.sparkContext
    sc.setJobGroup("jobs so far", "")
    spark.range(1).collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return max(sc.statusTracker().getJobIdsForGroup("jobs so far"))


def test_fits_share_their_passes_and_equal_separate_fits(spark):
    df = table(spark, np.random.default_rng(7).uniform(0, 1, (3000, 2)))
    ks, restarts, vectors = (3, 4, 5), 4, seg._vectors(df, XY).cache()
    judge, want, steps = ClusteringEvaluator(predictionCol="cluster"), [], []
    for k in ks:
        fits = [KMeans(k=k, seed=42 + i, maxIter=300, predictionCol="cluster").fit(vectors) for i in range(restarts)]
        steps += [m.summary.numIter for m in fits]
        best = min(fits, key=lambda m: m.summary.trainingCost)
        want.append((k, best.summary.trainingCost, judge.evaluate(best.transform(vectors))))
    began = jobs_so_far(spark)
    seg.cluster_sweep(df, XY, ks, restarts=restarts, iterations=1).collect()
    between = jobs_so_far(spark)
    got = seg.cluster_sweep(df, XY, ks, restarts=restarts).collect()
    more = (jobs_so_far(spark) - between) - (between - began)
    assert [tuple(r) for r in got] == [pytest.approx(row, rel=1e-9) for row in want]
    assert sum(steps) > 4 * max(steps)
    assert more <= 2 * max(steps) + 5, (more, steps)  # a pass is a job or two; the fits one by one took a job a step


def test_labels_equal_those_of_a_single_fit(spark):
    df = table(spark, np.random.default_rng(8).normal(0, 1, (500, 2)))
    vectors = seg._vectors(df, XY)
    fits = [KMeans(k=4, seed=42 + i, maxIter=300, predictionCol="cluster").fit(vectors) for i in range(3)]
    want = min(fits, key=lambda m: m.summary.trainingCost).transform(vectors)
    got = seg.cluster_labels(df.select("id"), df, XY, "id", 4, restarts=3)
    assert got.dtypes == [("id", "bigint"), ("cluster", "int")]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("id", "cluster").collect()))


def test_equal_points_and_centres_without_points(spark):
    """Fewer distinct points than centres; of equal centres the first has the points, the other stays."""
    df = table(spark, [(0, 0)] * 5 + [(4, 0)] * 3)
    assert [(r.k, r.inertia) for r in seg.cluster_sweep(df, XY, (2, 3), restarts=2).collect()] == [(2, 0.0), (3, 0.0)]
    starts = [np.array([[0.0, 0.0], [0.0, 0.0], [3.0, 0.0]]), np.array([[1.0, 0.0]])]
    (three, cost), (one, whole) = seg.refine(df, XY, starts, 300)
    assert three.tolist() == [[0, 0], [0, 0], [4, 0]] and cost == 0.0
    assert one.tolist() == [[1.5, 0]] and whole == pytest.approx(5 * 1.5**2 + 3 * 2.5**2)
    assert [r.n for r in df.select(seg.nearest(XY, three).alias("n")).collect()] == [0] * 5 + [2] * 3
    ((_, first_step),) = seg.refine(df, XY, starts[1:], 1)
    assert first_step == pytest.approx(5 * 1 + 3 * 9)  # the inertia met, as Spark's training cost
