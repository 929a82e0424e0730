"""Forecast and monitoring queries over a store."""

from pyspark.sql import functions as F

from tillwise.functions.numeric import fixed
from tillwise.operators import features as feat
from tillwise.operators import forecast as fc
from tillwise.operators import monitor as mon
from tillwise.plans.features import joined, split
from tillwise.sources.scratch import durable


def log(s):
    """The forecast log that the store holds; else computed and written once, read by every monitoring query."""
    found = s.stored("forecast_log")
    return s.keep("forecast_log", lambda: mon.walk_forward_log(joined(s))) if found is None else found


def plain(s):
    """Weekday-mean forecasts of the test weeks with their bounds."""
    train, test = feat.temporal_split(joined(s))
    return fc.residual_bounds(fc.weekday_mean_forecast(train, train), fc.weekday_mean_forecast(train, test))


def matrices(s):
    """Model matrices of the training and the test weeks."""
    matrix = s.keep("model_matrix", lambda: feat.feature_matrix(split(s)))
    return matrix.where(~F.col("is_test")), matrix.where("is_test")


def trees(s):
    """The point and quantile models that the store holds; else fitted once."""
    found = s.stored("trees")
    return s.keep("trees", lambda: fc.fit_models(feat.validation_split(matrices(s)[0]), s.settings.models)) if found is None else found


def boosted(s):
    _, test = matrices(s)
    return fc.tree_forecast(test, trees(s), {"point": "yhat"}).withColumn("y", F.col("sales_amt").cast("double"))


def boosted_bounds(s):
    """Forecast and quantile bounds of the test weeks, each row with its own."""
    found = fc.tree_forecast(matrices(s)[1], trees(s), {"point": "_point", "lower": "_lower", "upper": "_upper"})
    named = {"predicted": "_point", "lower": "_lower", "upper": "_upper"}
    return found.select("date", "division_code", "sales_amt", *[fixed(c, 2).alias(n) for n, c in named.items()])


def attribution(s):
    return fc.tree_contributions(matrices(s)[1], trees(s))


def comparison(s):
    labelled = feat.label_split(joined(s))
    return fc.model_comparison(
        {"autoregressive": fc.ar_baseline(labelled), "seasonal": fc.seasonal_regression(labelled), "boosted": boosted(s)}
    )


def least_squares_log(s):
    """The log of the regression model, refitted before every day."""
    rows = joined(s)
    fitted = fc.walk_forward_least_squares(feat.feature_matrix(feat.build_features(rows)))
    return mon.as_log(mon.with_band(fitted), mon.eligible_dates(rows))


def boosted_log(s):
    """The log of boosted trees and their quantile bounds, refitted every few weeks of history."""
    rows = joined(s)
    matrix = durable(feat.feature_matrix(feat.build_features(rows)))
    fitted = fc.walk_forward_boosted(matrix, mon.WARM_UP_WEEKS, s.settings.refit_weeks, s.settings.log_models)
    return mon.as_log(fitted, mon.eligible_dates(rows))


def day_contexts(s):
    return s.sales_days.select("date", "day_of_week", "event_flag")


PLANS = {
    "fc_ar_baseline": lambda s: fc.ar_baseline(feat.label_split(joined(s))),
    "fc_seasonal_regression": lambda s: fc.seasonal_regression(feat.label_split(joined(s))),
    "fc_gbt_point": lambda s: boosted(s).select("date", "division_code", "y", "yhat"),
    "fc_metrics": lambda s: mon.errors(plain(s), "sales_amt", "predicted", "division_code"),
    "fc_model_comparison": comparison,
    "fc_driver_attribution": attribution,
    "fc_driver_importance": lambda s: fc.driver_importance(attribution(s)),
    "fc_waterfall_topn": lambda s: fc.top_drivers(attribution(s)),
    "fc_quantile_bounds": lambda s: plain(s).select(
        "date", "division_code", "sales_amt", "predicted", "lower", "upper"
    ),
    "fc_coverage": lambda s: fc.coverage(plain(s)),
    "fc_boosted_bounds": boosted_bounds,
    "fc_boosted_coverage": lambda s: fc.coverage(boosted_bounds(s)),
    "fc_accuracy_lookup": lambda s: mon.lookup_from_log(log(s)),
    "fc_accuracy_in_sample": lambda s: mon.accuracy_lookup(
        fc.weekday_mean_forecast(feat.temporal_split(joined(s))[0], feat.temporal_split(joined(s))[0]),
        "sales_amt", "predicted",
    ),
    "fc_reliability_flag": lambda s: mon.reliability(day_contexts(s), mon.lookup_from_log(log(s))),
    "fc_walk_forward_log": log,
    "fc_walk_forward_regression": least_squares_log,
    "fc_walk_forward_boosted": boosted_log,
    "fc_signed_error": lambda s: log(s).select(
        "target_date", "division_code", "actual_sales", "predicted_sales", mon.signed_error().alias("signed_error_pct")
    ),
    "fc_context_parse": lambda s: mon.with_context(log(s)).select(
        "target_date", "division_code", "context_flags", "day_of_week"
    ),
    "fc_log_names": lambda s: mon.named_log(log(s), s.division_days),
    "fc_rolling_bias": lambda s: mon.rolling_bias(log(s)),
    "fc_bias_streak": lambda s: mon.bias_streaks(mon.rolling_bias(log(s))),
    "fc_bias_flags": lambda s: mon.bias_flags(log(s), s.division_days),
    "fc_actual_vs_pred_daily": lambda s: mon.daily_totals(plain(s), "date", actual="sales_amt", predicted="predicted"),
    "fc_ci_daily": lambda s: mon.daily_totals(
        plain(s), "date", actual="sales_amt", pred_median="predicted", pred_lower="lower", pred_upper="upper"
    ),
    "fc_seasonal_ci": lambda s: fc.seasonal_band(feat.label_split(joined(s)), s.settings.demo_division),
    "fc_bias_series": lambda s: mon.bias_series(log(s), s.settings.bias_group, s.settings.bias_weekday),
    "fc_error_heatmap": lambda s: mon.error_heatmap(log(s), s.division_days),
}
