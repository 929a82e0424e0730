"""Exact positions in a global order, for groups too large for one task.

An unpartitioned NTILE or percentile moves every row into a single task. Here the
measured columns alone are range-sorted over the cluster and written once; the row
counts per sorted partition then tell where the wanted positions lie, and only the few
rows at those positions travel to the driver.
"""

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tillwise.sources.scratch import durable

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def rows_at(df: DataFrame, order: list[tuple[str, bool]], positions_of) -> list[Row]:
    """Rows at zero-based positions of the order; `positions_of` maps the row count to positions.

    `order` lists (column, ascending) and must end in a unique column.
    """
    names = [name for name, _ in order]
    sort = [F.asc(n) if up else F.desc(n) for n, up in order]
    placed = durable(
        df.select(*names).orderBy(*sort).withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    ends = list(accumulate(r["n"] for r in sizes))
    wanted = positions_of(ends[-1] if ends else 0)
    places = []
    for p in wanted:
        i = bisect_right(ends, p)
        places.append((sizes[i]["part"] << _LOCAL_BITS) + p - (ends[i - 1] if i else 0))
    found = {r["_place"]: r for r in placed.where(F.col("_place").isin(places)).collect()} if places else {}
    return [found[p] for p in places]


def ntile_score(df: DataFrame, measure: str, key: str, buckets: int = 4, descending: bool = False) -> Column:
    """NTILE over (measure, key) as a row-wise column: a row scores one more than the cuts it lies beyond.

    The first n mod buckets tiles hold one extra row, as in SQL.
    """

    def last_rows(n: int) -> list[int]:
        sizes = [n // buckets + (i < n % buckets) for i in range(buckets)]
        return [end - 1 for end in list(accumulate(sizes))[:-1]] if n else []

    cuts = rows_at(df, [(measure, not descending), (key, True)], last_rows)
    kinds = dict(df.dtypes)
    score = F.lit(1)
    for cut in cuts:
        at = F.lit(cut[measure]).cast(kinds[measure])
        beyond = F.col(measure) < at if descending else F.col(measure) > at
        tied = (F.col(measure) == at) & (F.col(key) > F.lit(cut[key]).cast(kinds[key]))
        score = score + (beyond | tied).cast("int")
    return score.cast("bigint")


def quartiles(df: DataFrame, measure: str, key: str, fractions=(0.25, 0.5, 0.75)) -> list[float]:
    """Interpolated quantiles of a column over the whole frame."""

    def around(n: int) -> list[int]:
        spots = [q * (n - 1) for q in fractions]
        return [p for s in spots for p in (int(s), min(int(s) + 1, n - 1))]

    counted = []
    ends = rows_at(df, [(measure, True), (key, True)], lambda n: counted.append(n) or around(n))
    out = []
    for i, q in enumerate(fractions):
        spot = q * (counted[0] - 1)
        low, high = float(ends[2 * i][measure]), float(ends[2 * i + 1][measure])
        out.append(low + (high - low) * (spot - int(spot)))
    return out
