"""Properties of the plans that matter on large data."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tillwise.plans.registry import all_plans
from tillwise.sources.star import StarStore
from tests.conftest import SMALL

NO_PAIRS = [
    "div_annual_leaderboard", "rep_event_lift", "rep_store_summary", "prep_proportional_allocation", "prep_week_spine",
    "dash_scenario_rows", "nb_rfm_base", "feat_base_join", "fc_walk_forward_log", "div_share_of_store", "rep_top10_mix",
]


def plan_text(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_plan_forms_pairs(name, store):
    text = plan_text(all_plans()[name](store))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_year_reaches_the_scan_and_only_needed_columns_are_read(store):
    text = plan_text(all_plans()["eda_top_divisions_year"](store))
    assert "GreaterThanOrEqual(l_shipdate,1999-01-01" in text and "LessThan(l_shipdate,2000-01-01" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in text


def test_basket_amounts_do_not_read_the_lines(store):
    for name in ("nb_rfm_base", "rep_segment_mix", "rfm_event_crosstab"):
        assert "l_orderkey" not in plan_text(all_plans()[name](store))


def test_distinct_counts_are_pruned_when_unused(store):
    assert "l_orderkey" not in plan_text(all_plans()["win_weekly_rank"](store))


def test_windows_of_features_share_one_sort(store):
    from tillwise.operators.features import build_features
    from tillwise.plans.features import joined

    text = plan_text(build_features(joined(store)))
    tree = text.split("(1) Scan")[0]
    assert len(re.findall(r"hashpartitioning\(division_code#\d+, \d+\)", text)) <= 1
    assert len(re.findall(r"\bWindow\b", tree)) >= 1


def test_hot_product_is_split_by_adaptive_execution(spark, tmp_path):
    """A SKU with a third and more of all lines: the sort-merge join splits its partition."""
    raw = StarStore(spark, SMALL)
    lines = raw.raw("lineitem")
    hot = lines.withColumn("l_partkey", F.lit(7).cast("bigint"))
    lines.unionByName(hot).unionByName(hot).repartition(12).write.parquet(f"{tmp_path}/lineitem.parquet")
    raw.raw("part").write.parquet(f"{tmp_path}/part.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = StarStore(spark, str(tmp_path)).division_daily.select("date", "division_code", "sales_amt")
        total = sum(r.sales_amt for r in df.collect())
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert total == StarStore(spark, str(tmp_path)).division_daily.agg(F.sum("sales_amt")).first()[0]
