"""Feature queries over a store."""


from tillwise.operators import features as feat

ROW = ["date", "division_code"]


def joined(s):
    """Dense division days with their context; lags count rows, so no day may be missing.

    Training, test and history parts of a query all start from this one small table.
    """
    return s.keep("model_days", lambda: feat.base_join(s.dense_days, s.sales_days))


def built(s):
    return feat.build_features(joined(s))


def split(s):
    return feat.label_split(built(s))


PLANS = {
    "feat_base_join": lambda s: feat.base_join(s.division_daily, s.daily_sales),
    "feat_calendar": lambda s: joined(s).select(*ROW, *[c.alias(n) for n, c in feat.calendar_columns().items()]),
    "feat_event_onehot": lambda s: joined(s).select(*ROW, *[c.alias(n) for n, c in feat.event_columns().items()]),
    "feat_bool_to_int": lambda s: joined(s).select(*ROW, *[c.alias(n) for n, c in feat.flag_columns(joined(s)).items()]),
    "feat_lags": lambda s: joined(s).select(*ROW, "sales_amt", *[c.alias(n) for n, c in feat.lag_columns().items()]),
    "feat_rolling_lagged": lambda s: joined(s).select(
        *ROW, "sales_amt", *[c.alias(n) for n, c in feat.rolling_columns().items()]
    ),
    "feat_lag_364": lambda s: joined(s).select(
        *ROW, "sales_amt", *[c.alias(n) for n, c in feat.year_lag_column().items()]
    ),
    "feat_cold_snap": lambda s: joined(s).select(
        *ROW, "temperature_index", *[c.alias(n) for n, c in feat.cold_snap_column().items()]
    ),
    "build_features": built,
    "feat_series_frame": lambda s: feat.series_frame(joined(s), s.settings.demo_division),
    "split_temporal": lambda s: feat.label_split(joined(s)).select(*ROW, "sales_amt", "is_test"),
    "feature_matrix": lambda s: feat.feature_matrix(built(s)).drop("division_name", "day_of_week", "event_flag"),
    "split_validation": lambda s: feat.validation_split(feat.temporal_split(joined(s))[0]).select(
        *ROW, "sales_amt", "is_validation"
    ),
}
