"""Report-page queries over a store."""

from pyspark.sql import functions as F

from tillwise.functions.numeric import dbl
from tillwise.operators import dashboard as dash
from tillwise.operators import features as feat
from tillwise.operators import forecast as fc
from tillwise.operators import monitor as mon
from tillwise.plans.features import built, joined
from tillwise.plans.forecast import log, trees

RANGE = "3M"


def flags(s):
    return mon.bias_flags(log(s), s.division_days)


def scenarios(s):
    return dash.scenario_rows(dash.scenario_context(built(s)))


def scenario_forecast(s):
    """Answers of the forecast models to the scenario grid, with the bounds of the quantile models."""
    filled = scenarios(s).withColumns({f"x_{c}": F.coalesce(dbl(c), F.lit(0.0)) for c in feat.FEATURE_COLS})
    models = {"point": "yhat", "lower": "low", "upper": "high"}
    known = {r.plan for r in trees(s).select("plan").distinct().collect()}
    found = fc.tree_forecast(filled, trees(s), {m: c for m, c in models.items() if m in known})
    return dash.scenario_forecast(found, fc.FALLBACK_BAND)


def scenario_forecast_vs_history(s):
    """Each scenario's forecast against the average of the same division, month and weekday."""
    return dash.scenario_vs_history(scenario_forecast(s), joined(s))


def scenario_vs_history(s):
    model = fc.weekday_mean_model(joined(s))
    asked = scenarios(s).select("division_code", "month", "day_of_week", "event_flag")
    return dash.scenario_vs_history(asked.join(model, ["division_code", "day_of_week"]), joined(s))


PLANS = {
    "dash_filter_range": lambda s: dash.filter_range(s.sales_days, "date", RANGE),
    "dash_store_kpis": lambda s: dash.store_kpis(s.daily_sales, s.settings.year, s.settings.next_year),
    "dash_trend": lambda s: dash.trend(s.sales_days, RANGE),
    "dash_dow_average": lambda s: dash.dow_average(s.daily_sales),
    "dash_division_monthly": lambda s: dash.division_monthly(s.division_daily),
    "dash_division_totals": lambda s: dash.division_totals(s.division_daily),
    "dash_dept_rank": lambda s: dash.department_rank(s.division_daily),
    "dash_minmax_series": lambda s: dash.minmax_series(s.division_daily),
    "dash_scenario_context": lambda s: dash.scenario_context(built(s)),
    "dash_scenario_rows": scenarios,
    "dash_scenario_forecast": scenario_forecast,
    "dash_scenario_vs_history": scenario_vs_history,
    "dash_scenario_forecast_vs_history": scenario_forecast_vs_history,
    "dash_month_bars": lambda s: dash.month_bars(joined(s), s.settings.demo_division, "1Y"),
    "dash_mape_heatmap": lambda s: dash.mape_heatmap(mon.lookup_from_log(log(s))),
    "dash_ci_series": lambda s: dash.ci_series(mon.named_log(log(s), s.division_days), RANGE),
    "dash_top_flags": lambda s: dash.top_flags(flags(s)),
    "dash_flag_kpis": lambda s: dash.flag_kpis(flags(s)),
    "dash_division_list": lambda s: dash.division_list(log(s), mon.division_names(s.division_days)),
    "dash_bias_by_division": lambda s: dash.bias_of_division(
        mon.rolling_bias(mon.known_rows(log(s))), s.settings.demo_division, "1Y"
    ),
    "dash_bias_table": lambda s: dash.bias_table(flags(s)),
}
