"""Properties that the results of fitted models must have: rows checked, and rows that break them."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators import features as feat
from tillwise.operators import forecast as fc
from tillwise.operators import segments as seg
from tillwise.plans.features import joined
from tillwise.plans.forecast import attribution, boosted
from tillwise.plans.segments import labelled, scaled
from tillwise.sources.scratch import durable

NEAR = 1e-6
SETTLED = 0.01  # share by which a point may be nearer to another mean when the fit stops


def _counted(df: DataFrame, broken) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.coalesce(broken, F.lit(True))).alias("violations"))


def forecasts(s) -> DataFrame:
    """Every model forecasts every division and test day once, beside its actual sales."""
    labels = feat.label_split(joined(s))
    models = {"autoregressive": fc.ar_baseline(labels), "seasonal": fc.seasonal_regression(labels), "boosted": boosted(s)}
    actual = labels.where("is_test").select("date", "division_code", F.col("sales_amt").cast("double").alias("sold"))

    def of(name: str, found: DataFrame) -> DataFrame:
        once = found.groupBy("date", "division_code").agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("y"), F.max("yhat").alias("yhat"))
        both = actual.join(once, ["date", "division_code"], "full")
        return _counted(both, (F.col("n") != 1) | (F.col("y") != F.col("sold")) | F.isnan("yhat") | F.col("yhat").isNull()).select(F.lit(name).alias("model"), "*")

    return reduce(DataFrame.unionByName, [of(name, found) for name, found in models.items()])


def drivers(s) -> DataFrame:
    """Base and contributions of all features add up to the forecast that is served."""
    parts = attribution(s).groupBy("date", "division_code").agg(
        (F.max("base") + F.sum("contribution")).alias("total"), F.count_distinct("feature").alias("features")
    )
    both = boosted(s).select("date", "division_code", "yhat").join(parts, ["date", "division_code"], "full")
    off = F.abs(F.col("total") - F.col("yhat")) > NEAR * F.greatest(F.lit(1.0), F.abs("yhat"))
    return _counted(both, off | (F.col("features") != len(feat.FEATURE_COLS)))


def clusters(s) -> DataFrame:
    """Each customer lies nearest to the mean of its own cluster."""
    point = F.array(*[F.col(c).cast("double") for c in seg.MEASURES])
    points = durable(scaled(s).select("customer_id", point.alias("p")).join(labelled(s).select("customer_id", "cluster"), "customer_id", "left"))
    means = points.groupBy("cluster").agg(F.array(*[F.avg(F.col("p")[i]) for i in range(len(seg.MEASURES))]).alias("m"))
    all_means = means.agg(F.collect_list("m").alias("all")).scalar()  # one for each of a few clusters

    def distance(mean):
        return F.sqrt(F.aggregate(F.zip_with("p", mean, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))

    nearest = F.array_min(F.transform("all", distance))
    own = points.join(F.broadcast(means), "cluster", "left").withColumn("all", all_means)
    return _counted(own, distance(F.col("m")) > nearest * (1 + SETTLED) + NEAR)


PLANS = {"proof_forecasts": forecasts, "proof_drivers": drivers, "proof_clusters": clusters}
