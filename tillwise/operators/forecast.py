"""Point forecasts, bounds and driver attribution."""

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.numeric import dbl, fixed, mean, quantile, rnd
from tillwise.operators.boosting import fit_trees, with_contributions, with_forecast
from tillwise.operators.features import FEATURE_COLS, assemble, event_columns
from tillwise.operators.monitor import errors
from tillwise.settings import Boosting
from tillwise.sources.scratch import durable

# --- fixed values -----------------------------------------------------------
AR_LAGS = 7
MA_SHOCKS = 1
LOWER_QUANTILE, UPPER_QUANTILE = 0.15, 0.85
FALLBACK_BAND = 0.12
TOP_DRIVERS = 8
# ----------------------------------------------------------------------------
LONG_LAGS = 28  # of the first estimate of the shocks
ARMA_ROUNDS = 20
BENDS = 25  # change points of the trend
BENDS_WITHIN = 0.8  # of the history
BEND_PENALTIES = (0.1, 1.0, 10.0, 100.0)
ORIGINS = (0.5, 0.65, 0.8, 0.9)
ORIGIN_YEARS = 56 / 365.25
YEARLY_TERMS = 10
RIDGE = 1e-3
PREDICTION_SCHEMA = "date date, division_code int, y double, yhat double"


# --- weekday means -----------------------------------------------------------


def weekday_mean_model(train: DataFrame) -> DataFrame:
    return train.groupBy("division_code", "day_of_week").agg(fixed(mean("sales_amt"), 2).alias("predicted"))


def weekday_mean_forecast(train: DataFrame, rows: DataFrame) -> DataFrame:
    """The plainest model: a division's training mean for the weekday."""
    return rows.join(weekday_mean_model(train), ["division_code", "day_of_week"])


def error_bounds(train_scored: DataFrame) -> DataFrame:
    """The 15% and 85% quantile of the training errors per division.

    A division has one training error per day, so its exact quantile fits a task.
    """
    return (
        train_scored.withColumn("_error", F.col("sales_amt") - F.col("predicted"))
        .groupBy("division_code")
        .agg(
            quantile("_error", LOWER_QUANTILE).alias("low_error"),
            quantile("_error", UPPER_QUANTILE).alias("high_error"),
        )
    )


def residual_bounds(train_scored: DataFrame, scored: DataFrame) -> DataFrame:
    """Adds bounds: the forecast plus the quantiles of the division's training errors."""
    return (
        scored.join(error_bounds(train_scored), "division_code")
        .withColumns(
            {
                "lower": fixed(dbl("predicted") + F.col("low_error"), 2),
                "upper": fixed(dbl("predicted") + F.col("high_error"), 2),
            }
        )
        .drop("low_error", "high_error")
    )


def coverage(scored: DataFrame) -> DataFrame:
    inside = F.count_if(F.col("sales_amt").between(F.col("lower"), F.col("upper")))
    return scored.agg(
        F.count("*").alias("num_rows"), inside.alias("num_inside"), rnd(inside / F.count("*"), 4).alias("coverage")
    )


# --- per-division regressions ------------------------------------------------


def per_division(df: DataFrame, fit: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Fit each division on its own day series; a group is one row per day of history."""
    return df.groupBy("division_code").applyInPandas(fit, schema)


def ridge_solution(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    return np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T @ y)


def lagged(values: np.ndarray, lags: int) -> np.ndarray:
    """The values 1 to `lags` before each one, zero before the start."""
    return np.stack([np.concatenate((np.zeros(k), values[: len(values) - k])) for k in range(1, lags + 1)], axis=1)


def settles(weights: np.ndarray) -> bool:
    """Whether a recursion with these weights on its last values dies out: all roots lie inside the unit circle."""
    if not np.isfinite(weights).all():
        return False
    step = np.eye(len(weights), k=-1)
    step[:1] = weights
    return not len(weights) or bool(np.abs(np.linalg.eigvals(step)).max() < 1)


def yule_walker(series: np.ndarray, lags: int) -> np.ndarray:
    """Weights of the lags from the autocovariances: a little less exact than least squares, but they always settle."""
    n = len(series)
    around = np.array([series[k:] @ series[: n - k] / n for k in range(lags + 1)])
    ridge = RIDGE / n + 1e-9 * around[0]
    return np.linalg.solve(around[np.abs(np.subtract.outer(range(lags), range(lags)))] + ridge * np.eye(lags), around[1:])


def fit_arma(series: np.ndarray, lags: int, shocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the lags and of the shocks before, and the shocks themselves, by regressions.

    A long autoregression gives the first estimate of the shocks; regressing on lags and shocks gives
    weights, which give new shocks, until the weights settle. The rounds need not come to rest, so the one with
    the least shocks counts, of those that neither forecasts nor shocks grow without end by. Without any,
    the lags stand alone.
    """
    first = max(LONG_LAGS, lags + shocks) if len(series) > 4 * LONG_LAGS else lags
    x = lagged(series, first)
    noise = np.where(np.arange(len(series)) < first, 0.0, series - x @ ridge_solution(x[first:], series[first:]))
    own, weights, best = lagged(series, lags), np.zeros(lags + shocks), None
    known = slice(max(lags, shocks) + (first if shocks else 0), None)
    for _ in range(ARMA_ROUNDS):
        x = np.hstack((own, lagged(noise, shocks))) if shocks else own
        before, weights = weights, ridge_solution(x[known], series[known])
        weights[lags:] = np.clip(weights[lags:], -0.98, 0.98)  # beyond, the shocks would grow without end
        explained, noise = own @ weights[:lags], np.zeros(len(series))
        if not settles(-weights[lags:]):
            break
        for t in range(len(series)):
            past = noise[max(t - shocks, 0) : t][::-1]
            noise[t] = series[t] - explained[t] - past @ weights[lags : lags + len(past)] if t >= lags else 0.0
        left = float(noise[known] @ noise[known])
        if settles(weights[:lags]) and (best is None or left < best[0]):
            best = left, weights, noise
        if np.abs(weights - before).max() < 1e-4:
            break
    if best is None and shocks:
        weights, _, noise = fit_arma(series, lags, 0)
        return weights, np.zeros(shocks), noise
    if best is None:
        weights = yule_walker(series, lags)
        return weights, np.zeros(0), np.where(np.arange(len(series)) < lags, 0.0, series - own @ weights)
    return best[1][:lags], best[1][lags:], best[2]


def chosen_arma(series: np.ndarray, lags: int, shocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fit with shocks if it explains more than its further weights would by chance (Schwarz's criterion), else that of the lags alone."""
    plain, full = fit_arma(series, lags, 0), fit_arma(series, lags, shocks)
    since = min(lags + shocks + LONG_LAGS, len(series) // 2)
    n = len(series) - since
    left = [max(float(noise[since:] @ noise[since:]), 1e-12) for _, _, noise in (plain, full)]
    if n * np.log(left[1] / left[0]) + shocks * np.log(n) < 0:
        return full
    return plain[0], np.zeros(shocks), plain[2]


def ar_baseline(labelled: DataFrame, lags: int = AR_LAGS, shocks: int = MA_SHOCKS) -> DataFrame:
    """Autoregression with moving average on first differences per division, rolled forward over the test days."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        known = pdf.loc[~pdf["is_test"], "y"].to_numpy()
        test = pdf[pdf["is_test"]]
        steps = np.diff(known)
        if len(steps) <= 2 * (lags + shocks):
            return test.assign(yhat=known[-1] if len(known) else 0.0)[["date", "division_code", "y", "yhat"]]
        weights, of_shocks, noise = chosen_arma(steps, lags, shocks)
        recent, noise, level, out = list(steps[-lags:]), list(noise[len(noise) - shocks :]), known[-1], []
        for _ in range(len(test)):
            step = float(np.dot(weights, recent[::-1][:lags]) + np.dot(of_shocks, noise[::-1][:shocks]))
            recent.append(step)
            noise.append(0.0)
            level += step
            out.append(level)
        return test.assign(yhat=out)[["date", "division_code", "y", "yhat"]]

    series = labelled.select("date", "division_code", dbl("sales_amt").alias("y"), "is_test")
    return per_division(series, fit, PREDICTION_SCHEMA)


def seasonal_terms() -> F.Column:
    """Intercept, trend, yearly waves, weekday dummies and event dummies as one array."""
    years = F.unix_date("date") / F.lit(365.25)
    angle = years * F.lit(2 * np.pi)
    waves = [f(angle * k) for k in range(1, YEARLY_TERMS + 1) for f in (F.sin, F.cos)]
    weekdays = [(F.weekday("date") == i).cast("double") for i in range(1, 7)]
    events = [dbl(c) for c in event_columns("").values()]
    return F.array(F.lit(1.0), years - 30.0, *waves, *weekdays, *events)


def trend_bends(years: np.ndarray, upto: float) -> np.ndarray:
    """Columns that are zero up to a change point and rise from there; the points lie evenly over the first part of the history."""
    points = np.linspace(years.min(), years.min() + BENDS_WITHIN * (upto - years.min()), BENDS + 2)[1:-1]
    return np.maximum(years[:, None] - points, 0.0)


def penalised(x: np.ndarray, y: np.ndarray, bends: int, penalty: float) -> np.ndarray:
    """Least squares with a penalty on the last columns."""
    ridge = np.full(x.shape[1], RIDGE)
    ridge[len(ridge) - bends :] += penalty
    return np.linalg.solve(x.T @ x + np.diag(ridge), x.T @ y)


def chosen_penalty(x: np.ndarray, years: np.ndarray, y: np.ndarray) -> float:
    """The penalty on change points whose forecasts of days not yet seen are best, from several origins; infinite: no change points."""
    errors = dict.fromkeys((*BEND_PENALTIES, np.inf), 0.0)
    for share in ORIGINS:
        cut = years.min() + share * (years.max() - years.min())
        seen = years <= cut
        ahead = ~seen & (years <= cut + ORIGIN_YEARS)
        if seen.sum() <= 2 * (x.shape[1] + BENDS) or not ahead.any():
            continue
        bends = trend_bends(years, cut)
        both = np.hstack((x, bends))
        for penalty in errors:
            if np.isinf(penalty):
                yhat = x[ahead] @ ridge_solution(x[seen], y[seen])
            else:
                yhat = both[ahead] @ penalised(both[seen], y[seen], BENDS, penalty)
            errors[penalty] += float(((y[ahead] - yhat) ** 2).sum())
    return min(errors, key=lambda p: (errors[p], -p))


def seasonal_fit(x: np.ndarray, years: np.ndarray, y: np.ndarray, train: np.ndarray) -> np.ndarray:
    """Fitted values of all days from those of the training days."""
    penalty = chosen_penalty(x[train], years[train], y[train])
    if np.isinf(penalty):
        return x @ ridge_solution(x[train], y[train])
    both = np.hstack((x, trend_bends(years, years[train].max())))
    return both @ penalised(both[train], y[train], BENDS, penalty)


def seasonal_regression(labelled: DataFrame, keep_train: bool = False) -> DataFrame:
    """Yearly and weekly seasonality with event effects and a trend with change points, one least-squares fit per division."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy()
        pdf = pdf.assign(yhat=seasonal_fit(x, pdf["years"].to_numpy(), y, ~pdf["is_test"].to_numpy()))
        return pdf[["date", "division_code", "y", "yhat", "is_test"]]

    years = (F.unix_date("date") / F.lit(365.25)).alias("years")
    design = labelled.select(
        "date", "division_code", dbl("sales_amt").alias("y"), "is_test", seasonal_terms().alias("x"), years
    )
    out = per_division(design, fit, PREDICTION_SCHEMA + ", is_test boolean")
    return out if keep_train else out.where("is_test").drop("is_test")


def seasonal_band(labelled: DataFrame, code: int) -> DataFrame:
    """Test forecast of one division with the 70% band of its training errors."""
    fitted = seasonal_regression(labelled.where(F.col("division_code") == code), keep_train=True)
    everything = Window.partitionBy("division_code")
    error = F.when(~F.col("is_test"), F.col("y") - F.col("yhat"))
    return (
        fitted.withColumns(
            {
                "_low": F.percentile(error, LOWER_QUANTILE).over(everything),
                "_high": F.percentile(error, UPPER_QUANTILE).over(everything),
            }
        )
        .where("is_test")
        .select(
            F.col("date").alias("ds"), "y", "yhat",
            (F.col("yhat") + F.col("_low")).alias("yhat_lower"),
            (F.col("yhat") + F.col("_high")).alias("yhat_upper"),
        )
        .orderBy("ds")
    )


# --- models over all divisions -----------------------------------------------


MODEL_COLUMNS = [f"x_{c}" for c in FEATURE_COLS]
ROW = ["date", "division_code"]


def fit_models(train: DataFrame, models: dict[str, Boosting], only: dict | None = None) -> DataFrame:
    """The trees of all models in one table; those with patience hold out the rows of is_validation."""
    return fit_trees(train, MODEL_COLUMNS, "sales_amt", models, ROW, "division_code", only)


def tree_forecast(matrix: DataFrame, trees: DataFrame, names: dict[str, str], prefix: F.Column | None = None) -> DataFrame:
    """Adds a column for each named model. prefix: what the names of a row's models begin with."""
    for model, name in names.items():
        plan = F.lit(model) if prefix is None else F.concat(prefix, F.lit(model))
        matrix = with_forecast(matrix, trees, MODEL_COLUMNS, "division_code", plan, name)
    return matrix


def tree_contributions(matrix: DataFrame, trees: DataFrame, model: str = "point") -> DataFrame:
    """Shapley values of each feature in each forecast; base plus contributions is the forecast."""
    wide = with_contributions(
        matrix.select(*ROW, *MODEL_COLUMNS), trees, MODEL_COLUMNS, "division_code", F.lit(model), [f"part_{c}" for c in FEATURE_COLS]
    )
    return _long_parts(wide, FEATURE_COLS)


def _long_parts(wide: DataFrame, columns: list[str]) -> DataFrame:
    return wide.unpivot([*ROW, "base"], [f"part_{c}" for c in columns], "feature", "contribution").withColumn(
        "feature", F.substring("feature", len("part_") + 1, 99)
    )


def fit_linear(train: DataFrame):
    linear = LinearRegression(featuresCol="features", labelCol="label", regParam=1e-3, solver="normal")
    return linear.fit(assemble(train.withColumn("label", dbl("sales_amt"))))


def predict(model, matrix: DataFrame) -> DataFrame:
    return model.transform(assemble(matrix)).drop("features").withColumnRenamed("prediction", "yhat")


def model_comparison(predictions: dict[str, DataFrame]) -> DataFrame:
    """MAPE and RMSE side by side, one row per model."""
    labelled = [
        df.select(F.lit(name).alias("model"), fixed("y", 2).alias("y"), fixed("yhat", 2).alias("yhat"))
        for name, df in predictions.items()
    ]
    return errors(reduce(DataFrame.unionByName, labelled), "y", "yhat", "model").orderBy("model")


def contributions(model, train: DataFrame, rows: DataFrame, columns=FEATURE_COLS) -> DataFrame:
    """Share of each feature in each forecast of a linear model, and the base they start from.

    A feature adds its coefficient times its distance from the training mean; base plus
    contributions is the forecast.
    """
    means = train.agg(F.struct(*[F.avg(f"x_{c}").alias(c) for c in columns])).scalar()
    weights = dict(zip(columns, model.coefficients.tolist()))
    base = reduce(lambda a, b: a + b, [F.col(f"_m.{c}") * w for c, w in weights.items()]) + float(model.intercept)
    parts = [((F.col(f"x_{c}") - F.col(f"_m.{c}")) * w).alias(f"part_{c}") for c, w in weights.items()]
    wide = rows.withColumn("_m", means).select("date", "division_code", base.alias("base"), *parts)
    return _long_parts(wide, columns)


def driver_importance(attribution: DataFrame) -> DataFrame:
    return (
        attribution.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
        .orderBy(F.desc("mean_abs_contribution"), "feature")
    )


def top_drivers(attribution: DataFrame, n: int = TOP_DRIVERS) -> DataFrame:
    """The n strongest contributions of each row."""
    strongest = Window.partitionBy("date", "division_code").orderBy(F.desc(F.abs("contribution")), "feature")
    return attribution.withColumn("position", F.row_number().over(strongest)).where(F.col("position") <= n)


# --- walk-forward least squares ----------------------------------------------


def walk_forward_least_squares(matrix: DataFrame, columns=FEATURE_COLS) -> DataFrame:
    """Refit a regression before every day, from running cross-products of the days before.

    One pass per division instead of one refit per date over a growing prefix.
    """
    names = [f"x_{c}" for c in columns if c != "division_code"]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        x, y = np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy()
        size = x.shape[1]
        yhat = np.full(len(y), np.nan)
        if len(y) > size:
            # everything a day's fit sees comes from the days before it, the columns' scale too
            scale = np.maximum(np.maximum.accumulate(np.abs(x), axis=0), 1e-9)[size - 1 : -1]
            gram = np.cumsum(x[:, :, None] * x[:, None, :], axis=0)[size - 1 : -1] / (scale[:, :, None] * scale[:, None, :])
            moment = np.cumsum(x * y[:, None], axis=0)[size - 1 : -1] / scale
            weights = np.linalg.solve(gram + RIDGE * np.eye(size), moment[:, :, None])[:, :, 0]
            yhat[size:] = (x[size:] / scale * weights).sum(axis=1)
        return pdf.assign(yhat=yhat)[["date", "division_code", "day_of_week", "event_flag", "sales_amt", "yhat"]]

    design = matrix.select(
        "date", "division_code", "day_of_week", "event_flag", "sales_amt", dbl("sales_amt").alias("y"),
        F.array(F.lit(1.0), *map(F.col, names)).alias("x"),
    )
    fitted = per_division(
        design, fit,
        "date date, division_code int, day_of_week string, event_flag string, sales_amt decimal(18,2), yhat double",
    ).where(F.col("yhat").isNotNull() & ~F.isnan("yhat"))
    return fitted.withColumn("predicted_sales", fixed("yhat", 2)).drop("yhat")


# --- walk-forward boosted trees ------------------------------------------------


def walk_forward_boosted(matrix: DataFrame, warm_up_weeks: int, every_weeks: int, models: dict[str, Boosting]) -> DataFrame:
    """Refit the trees every few weeks on the days before, and forecast the days up to the next refit.

    All refits are groups of one job: a row goes to every refit after its day. Only the refit dates are listed on the driver.
    """
    first, last = matrix.agg(F.min("date"), F.max("date")).first()
    step = timedelta(weeks=every_weeks)
    cuts = [first + timedelta(weeks=warm_up_weeks)]
    while cuts[-1] + step <= last:
        cuts.append(cuts[-1] + step)
    plans = {f"{cut}/{name}": plan for cut in cuts for name, plan in models.items()}
    only = {name: F.col("date") < F.lit(name.split("/")[0]).cast("date") for name in plans}
    trees = durable(fit_models(matrix, plans, only))
    since = F.lit(str(cuts[0])).cast("date")
    cut = F.date_add(since, F.floor(F.datediff("date", since) / (7 * every_weeks)).cast("int") * (7 * every_weeks))
    ahead = matrix.where(F.col("date") >= since).withColumn("_cut", cut.cast("string"))
    found = tree_forecast(ahead, trees, {m: f"_{m}" for m in models}, F.concat("_cut", F.lit("/")))
    named = {"point": "predicted_sales", "lower": "lower_bound", "upper": "upper_bound"}
    return found.withColumns({name: fixed(f"_{m}", 2) for m, name in named.items()}).drop("_cut", *[f"_{m}" for m in models])
