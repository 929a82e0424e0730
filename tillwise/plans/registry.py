"""All queries by name: each takes a session and a directory of star-schema tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.plans.present import present
from tillwise.sources.star import StarStore
from tillwise.sources.store import Store

Plan = Callable[[Store], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]


def as_query(plan: Plan) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return present(plan(StarStore(spark, directory)))

    return run


def all_plans() -> dict[str, Plan]:
    from tillwise.plans import dashboard, features, forecast, prep, proofs, sales, segments, tables

    plans: dict[str, Plan] = {}
    for module in (tables, sales, segments, prep, features, forecast, dashboard, proofs):
        plans.update(module.PLANS)
    return plans


def all_queries() -> dict[str, Query]:
    return {name: as_query(plan) for name, plan in all_plans().items()}
