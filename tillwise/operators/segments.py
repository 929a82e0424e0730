"""Customer segmentation: recency, frequency and monetary scores, clusters, cross-tabs."""

from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.calendar import COLD_SNAP_BELOW, NO_EVENT
from tillwise.functions.numeric import MONEY, dbl, mean, pct, rnd, total
from tillwise.operators.order_stats import ntile_score, quartiles
from tillwise.sources.scratch import durable

MEASURES = ["recency_days", "frequency", "monetary"]
SETTLED = 1e-4  # a centre that moves less has come to rest, as in Spark's K-means
CHUNK = 1024  # points that meet all centres at once in a task
SIDE_BY_SIDE = 4  # initialisations that run at once


def rfm_base(transactions: DataFrame, customers: DataFrame, daily: DataFrame) -> DataFrame:
    """Days since the last visit, visits and spend per customer.

    Baskets are summed per customer before the customer join, so a customer with very
    many baskets reaches it as one row.
    """
    today = daily.agg(F.max("date")).scalar()
    visits = transactions.groupBy("customer_id").agg(
        F.max("date").alias("_last"),
        F.count("*").alias("frequency"),
        total("total_amount").cast(MONEY).alias("monetary"),
    )
    who = customers.select("customer_id", "customer_type", "nationality", "age_band")
    return who.join(visits, "customer_id").select(
        *who.columns, F.date_diff(today, "_last").alias("recency_days"), "frequency", "monetary"
    )


def segment_name(r: Column, f: Column, m: Column) -> Column:
    """Segment of a score triple; the first rule that fits wins."""
    return (
        F.when((r == 4) & (f >= 3) & (m >= 3), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r == 4) & (f <= 2), "Recent Customers")
        .when((r >= 3) & (f <= 2) & (m >= 3), "Potential Loyalists")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r == 1) & (f >= 3), "Cant Lose Them")
        .when((r <= 2) & (m >= 3), "Hibernating High Value")
        .otherwise("Low Value")
    )


def rfm_scored(base: DataFrame) -> DataFrame:
    base = durable(base)
    scored = base.withColumns(
        {
            "r_score": ntile_score(base, "recency_days", "customer_id", descending=True),
            "f_score": ntile_score(base, "frequency", "customer_id"),
            "m_score": ntile_score(base, "monetary", "customer_id"),
        }
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumns({"rfm_total": r + f + m, "rfm_segment": segment_name(r, f, m)})


def rfm_segments(base: DataFrame) -> DataFrame:
    return rfm_scored(base).orderBy(F.desc("rfm_total"), "customer_id")


def rfm_summary(base: DataFrame) -> DataFrame:
    return (
        rfm_scored(base)
        .groupBy("rfm_segment", "customer_type")
        .agg(
            F.count("*").alias("num_customers"),
            rnd(mean("recency_days"), 1).alias("avg_recency_days"),
            rnd(mean("frequency"), 1).alias("avg_frequency"),
            rnd(mean("monetary"), 2).alias("avg_monetary"),
            rnd(total("monetary"), 0).alias("total_revenue"),
        )
        .orderBy("rfm_segment", "customer_type")
    )


def baskets_by_day(transactions: DataFrame, *extra: str) -> DataFrame:
    """Basket sums per day and customer type: what the day-context cross-tabs need, in one small frame."""
    return transactions.groupBy("date", "customer_type").agg(
        F.count("*").alias("_n"),
        total("total_amount").alias("_amount"),
        *[total(c).alias(f"_{c}") for c in extra],
    )


def temp_crosstab(transactions: DataFrame, daily: DataFrame, cold: str, normal: str) -> DataFrame:
    condition = F.when(F.col("temperature_index") < COLD_SNAP_BELOW, cold).otherwise(normal)
    n = F.sum("_n")
    return (
        baskets_by_day(transactions, "num_items")
        .join(daily.select("date", "temperature_index"), "date")
        .groupBy(condition.alias("temp_condition"), "customer_type")
        .agg(
            n.alias("num_transactions"),
            rnd(dbl(total("_amount")) / n, 2).alias("avg_basket"),
            rnd(dbl(total("_num_items")) / n, 2).alias("avg_items"),
        )
        .orderBy("temp_condition", "customer_type")
    )


def event_crosstab(transactions: DataFrame, daily: DataFrame, events_only: bool = True) -> DataFrame:
    context = daily.select("date", "event_flag")
    if events_only:
        context = context.where(F.col("event_flag") != NO_EVENT)
    n = F.sum("_n")
    return (
        baskets_by_day(transactions)
        .join(context, "date")
        .groupBy("event_flag", "customer_type")
        .agg(
            n.alias("num_transactions"),
            rnd(dbl(total("_amount")) / n, 2).alias("avg_basket"),
            rnd(total("_amount"), 0).alias("total_spend"),
        )
        .orderBy("event_flag", F.desc("total_spend"))
    )


def spread(col: str, sample: bool) -> Column:
    """Standard deviation from exact sums, the same on every run and partitioning."""
    n, s = F.count(col), dbl(F.sum(col))
    squares = dbl(F.sum((F.col(col) * F.col(col)).cast("decimal(38,4)")))
    spare = F.greatest(F.lit(0.0), squares - s * s / n)
    return F.sqrt(spare / F.nullif(n - (1 if sample else 0), F.lit(0)))


def describe(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, one row per column."""
    df = durable(df.select(key, *columns))
    parts = []
    for c in columns:
        q1, q2, q3 = quartiles(df, c, key)
        parts.append(
            df.agg(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                rnd(mean(c), 4).alias("mean"),
                rnd(spread(c, sample=True), 4).alias("std"),
                dbl(F.min(c)).alias("min"),
                rnd(F.lit(q1), 4).alias("q1"), rnd(F.lit(q2), 4).alias("median"), rnd(F.lit(q3), 4).alias("q3"),
                dbl(F.max(c)).alias("max"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def standardise(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Z-scores with the population deviation; the moments come in as one scalar row."""
    moments = df.agg(
        F.struct(*[mean(c).alias(f"{c}_mean") for c in columns], *[spread(c, False).alias(f"{c}_std") for c in columns])
    ).scalar()
    staged = df.select(key, *columns).withColumn("_m", moments)
    return staged.select(
        key,
        *[
            rnd((dbl(c) - F.col(f"_m.{c}_mean")) / F.nullif(F.col(f"_m.{c}_std"), F.lit(0.0)), 6).alias(c)
            for c in columns
        ],
    )


def _vectors(scaled: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(scaled)


def _blocks(points: DataFrame, columns: list[str]) -> DataFrame:
    """The points as blocks of coordinates, which every pass reads at little cost."""

    def pack(batches):
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns]).astype(float)
            parts = [rows[at : at + CHUNK].tobytes() for at in range(0, len(rows), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["block"])

    return durable(points.select(*columns).mapInArrow(pack, "block binary"))


def _tally(models: list[np.ndarray]):
    """What a task adds to one step of several models: a row of size, sums and sum of squares per centre.

    Centres are stacked by their number within the model, models with more centres first, so that the
    j-th centres of all models that have one are neighbours. Returned with the (model, centre) of each.
    """
    order = sorted(range(len(models)), key=lambda i: -len(models[i]))
    slots = [(i, j) for j in range(len(models[order[0]])) for i in order if len(models[i]) > j]
    centres = np.array([models[i][j] for i, j in slots])
    ends = np.cumsum([sum(len(m) > j for m in models) for j in range(len(models[order[0]]))])
    width, plane = centres.shape[1], np.hstack([-centres, (centres * centres).sum(axis=1, keepdims=True) / 2])

    def run(batches):
        found = np.zeros((len(slots), width + 2))
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer()).reshape(-1, width)
                ones = np.ones((len(x), 1))
                far = plane @ np.hstack([x, ones]).T  # half the squared distance, less half the square of the point
                best = far[: ends[0]].copy()
                for a, b in zip(ends, ends[1:]):
                    np.minimum(best[: b - a], far[a:b], out=best[: b - a])
                free, own = np.ones(best.shape, bool), np.empty(far.shape)
                for a, b in zip([0, *ends], ends):  # of centres equally near the first has the point
                    hit = (far[a:b] == best[: b - a]) & free[: b - a]
                    free[: b - a] ^= hit
                    own[a:b] = hit
                found += own @ np.hstack([ones, x, (x * x).sum(axis=1, keepdims=True)])
        kept = np.flatnonzero(found[:, 0])
        if len(kept):
            yield pa.RecordBatch.from_arrays([pa.array(kept), *[pa.array(v) for v in found[kept].T]], ["slot", *[f"v{i}" for i in range(width + 2)]])

    return slots, run


def refine(points: DataFrame, columns: list[str], models: list[np.ndarray], iterations: int) -> list[tuple[np.ndarray, float]]:
    """Lloyd's steps from each model's first centres until they move no more, with the inertia met by the last step.

    All models that still move share the passes over the points, so there are as many passes as the
    longest of the fits has steps. Tasks send sums per centre, whatever the number of points.
    """
    blocks, names = _blocks(points, columns), [f"v{i}" for i in range(len(columns) + 2)]
    models, inertia = [np.array(m, dtype=float) for m in models], [0.0] * len(models)
    moving = list(range(len(models)))
    for _ in range(iterations):
        if not moving:
            break
        slots, run = _tally([models[i] for i in moving])
        parts = blocks.mapInArrow(run, "slot bigint, " + ", ".join(f"{v} double" for v in names))
        moved = set()
        for i in moving:
            inertia[i] = 0.0
        for slot, size, *sums, squares in parts.groupBy("slot").agg(*[F.sum(v) for v in names]).collect():
            i, j = moving[slots[slot][0]], slots[slot][1]
            old, new = models[i][j].copy(), np.array(sums) / size  # a centre without points stays
            inertia[i] += max(squares - 2 * old @ sums + size * old @ old, 0.0)
            if ((new - old) ** 2).sum() > SETTLED**2:
                moved.add(i)
            models[i][j] = new
        moving = sorted(moved)
    return list(zip(models, inertia))


def fit_clusters(points: DataFrame, columns: list[str], ks, seed: int, restarts: int = 10, iterations: int = 300) -> list[tuple[np.ndarray, float]]:
    """K-means for each k: centres and inertia of the one of several restarts with the least inertia.

    The first centres are those of Spark's K-means with the same seed.
    """
    vectors = _vectors(points, columns)

    def start(task: tuple[int, int]) -> np.ndarray:
        first = KMeans(k=task[0], seed=seed + task[1], maxIter=0, featuresCol="features", predictionCol="cluster").fit(vectors)
        return np.array(first.clusterCenters())

    with ThreadPool(SIDE_BY_SIDE) as pool:
        models = pool.map(start, [(k, i) for k in ks for i in range(restarts)], chunksize=1)
    fits = refine(points, columns, models, iterations)
    return [min(fits[at : at + restarts], key=lambda fit: fit[1]) for at in range(0, len(fits), restarts)]


def nearest(columns: list[str], centres: np.ndarray) -> Column:
    """Number of the centre nearest to a point."""
    far = F.array(*[reduce(lambda a, b: a + b, [(F.col(c) - float(v)) * (F.col(c) - float(v)) for c, v in zip(columns, centre)]) for centre in centres])
    return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def cluster_sweep(scaled: DataFrame, columns: list[str], ks=range(2, 8), seed: int = 42, restarts: int = 10, iterations: int = 300) -> DataFrame:
    """Inertia and silhouette for each k. Silhouette uses squared distances, which needs one pass."""
    points = durable(scaled)
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    found = []
    for k, (centres, inertia) in zip(ks, fit_clusters(points, columns, ks, seed, restarts, iterations)):
        labelled = _vectors(points, columns).withColumn("cluster", nearest(columns, centres))
        found.append((k, float(inertia), float(judge.evaluate(labelled))))
    return scaled.sparkSession.createDataFrame(found, "k int, inertia double, silhouette double")


def cluster_labels(base: DataFrame, scaled: DataFrame, columns: list[str], key: str, k: int = 4, seed: int = 42, restarts: int = 10, iterations: int = 300):
    points = durable(scaled)
    ((centres, _),) = fit_clusters(points, columns, [k], seed, restarts, iterations)
    return base.join(points.select(key, nearest(columns, centres).alias("cluster")), key)


def cluster_means(labelled: DataFrame, columns: list[str]) -> DataFrame:
    return (
        labelled.groupBy("cluster")
        .agg(F.count("*").alias("num_customers"), *[rnd(mean(c), 1).alias(c) for c in columns])
        .orderBy("cluster")
    )


def crosstab_share(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Row-normalised cross-tab in percent, one column per value."""
    counts = df.groupBy(row).pivot(column, values).count().na.fill(0)
    whole = reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values])
    return counts.select(row, *[rnd(pct(F.col(f"`{v}`"), whole), 4).alias(v) for v in values]).orderBy(row)


def melt(wide: DataFrame, key: str, name: str) -> DataFrame:
    values = [c for c in wide.columns if c != key]
    return wide.unpivot(key, values, name, "value").orderBy(key, name)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A reproducible sample: the n rows whose seeded key hashes come first.

    Only rows under a hash threshold can be among them, so only about n rows are
    sorted, whatever the size of the frame.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    hashed = df.withColumn("_digest", digest)
    rows = df.count()
    bound = min(1.0, (n + 8 * n**0.5 + 50) / max(rows, 1))
    if bound < 1.0:
        below = hashed.where(F.col("_digest") < F.lit(f"{int(bound * 16**8):08x}"))
        if below.count() >= n:
            hashed = below
    return hashed.orderBy("_digest", key).limit(n).drop("_digest")
