"""Fit every model once, keep what the report pages need, and read it back."""

from pyspark.ml.regression import LinearRegressionModel

from tillwise.functions.numeric import fixed
from tillwise.operators import forecast as fc
from tillwise.operators import monitor as mon
from tillwise.plans.forecast import log, matrices, trees
from tillwise.sources.store import Store
from tillwise.sources.tables import exists, write_parquet

_MODELS = {"driver_model": LinearRegressionModel}
_TABLES = ["trees", "error_bounds", "test_metrics", "accuracy_lookup", "forecast_log", "bias_flags"]


def train_all(store: Store, path: str) -> None:
    """Point and quantile forecasts, driver model, bounds, accuracy by context, forecast log and bias flags.

    In the folder `models` of a FileStore, the trees answer its later queries.
    """
    train, test = matrices(store)
    fc.fit_linear(train).write().overwrite().save(f"{path}/driver_model")

    scored = lambda rows: fc.tree_forecast(rows, trees(store), {"point": "yhat"}).withColumn("predicted", fixed("yhat", 2))
    on_train, on_test = scored(train), scored(test)
    entries = log(store)
    tables = {
        "trees": trees(store),
        "error_bounds": fc.error_bounds(on_train),
        "test_metrics": mon.errors(on_test, "sales_amt", "predicted"),
        "accuracy_lookup": mon.accuracy_lookup(on_train, "sales_amt", "predicted"),
        "forecast_log": entries,
        "bias_flags": mon.bias_flags(entries, store.division_days),
    }
    for name in _TABLES:
        write_parquet(tables[name], f"{path}/{name}")


def load_all(spark, path: str) -> dict:
    """Everything found under the path; what was not trained is left out."""
    found = {}
    for name, model in _MODELS.items():
        if exists(spark, f"{path}/{name}/metadata"):
            found[name] = model.load(f"{path}/{name}")
    for name in _TABLES:
        if exists(spark, f"{path}/{name}"):
            found[name] = spark.read.parquet(f"{path}/{name}")
    return found
