"""Source, sink and contract queries over a store."""

from functools import reduce

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators import contract, sales
from tillwise.operators import forecast as fc
from tillwise.operators import monitor as mon
from tillwise.plans.forecast import log, matrices
from tillwise.plans.prep import inventory
from tillwise.plans.present import present
from tillwise.sources import tables as io
from tillwise.sources.schemas import conform
from tillwise.sources.scratch import durable, scratch_path, shuffles_removed

# The column of each table whose sum is shown next to its row count.
SUMMED = {
    "products": "unit_price",
    "customers": "total_spend",
    "daily_sales": "actual_sales",
    "division_daily": "sales_amt",
    "transactions": "total_amount",
    "transaction_items": "quantity",
    "inventory": "units_sold",
}


def seven_tables(s) -> dict[str, DataFrame]:
    return {t: inventory(s) if t == "inventory" else getattr(s, t) for t in SUMMED}


def csv_tables(s):
    """Write the seven tables as CSV, read them back with their schemas, and sum them up.

    The inventory has a row for each SKU and week, many times the input, so the files are packed. What a table was
    shuffled for goes before the next is written.
    """
    folder = scratch_path(s.spark, "csv")
    parts = []
    for table in SUMMED:
        with shuffles_removed(s.spark):
            frame = inventory(s, settled=True) if table == "inventory" else getattr(s, table)
            io.write_csv(conform(frame, table), f"{folder}/{table}.csv", packed=True)
        back = io.read_csv_table(s.spark, folder, table)
        parts.append(
            back.agg(F.count("*").alias("num_rows"), F.sum(SUMMED[table]).cast("double").alias("column_sum")).select(
                F.lit(table).alias("table_name"), "num_rows", "column_sum"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def csv_columns(s):
    folder = scratch_path(s.spark, "csv")
    io.write_csv(conform(s.transactions, "transactions"), f"{folder}/transactions.csv")
    return io.read_csv_columns(s.spark, folder, "transactions", ["transaction_id", "date"])


def sql_text(s):
    """SQL over a view whose dates are text, with the date parsed on the way out."""
    return io.sql_frame(
        s.spark,
        "SELECT date, day_of_week, actual_sales, target FROM daily_view WHERE event_flag <> 'None' ORDER BY date",
        {"daily_view": present(s.daily_sales)},
        dates=["date"],
    )


def optional_tables(s):
    """One table that was written and one that was not: the missing one reads as empty."""
    folder = scratch_path(s.spark, "parquet")
    io.write_parquet(conform(s.daily_sales, "daily_sales"), f"{folder}/daily_sales")
    found = {t: io.read_optional(s.spark, folder, t) for t in ("daily_sales", "forecast_log")}
    return contract.row_counts(found)


def csv_sink(s):
    path = scratch_path(s.spark, "monthly")
    result = sales.monthly_sales(s.daily_sales)
    io.write_csv(result, path)
    return s.spark.read.schema(result.schema).option("header", True).csv(path)


def table_sink(s):
    """Write a catalog table twice; the second write replaces the first."""
    name, path = "division_totals_table", scratch_path(s.spark, "division_totals_table")
    totals = sales.division_annual(s.division_daily)
    io.replace_table(totals.limit(0), name, path)
    io.replace_table(totals, name, path)
    return s.spark.table(name)


def artefacts(s):
    """Save and reload the driver model and the lookups, and count what came back different."""
    train, test = matrices(s)
    folder = scratch_path(s.spark, "artefacts")
    model = fc.fit_linear(train)
    model.write().overwrite().save(f"{folder}/driver_model")
    again = LinearRegressionModel.load(f"{folder}/driver_model")
    key = ["date", "division_code"]
    before = fc.predict(model, test).select(*key, "yhat")
    after = fc.predict(again, test).select(*key, F.col("yhat").alias("reloaded"))
    differs = F.count_if(~F.col("yhat").eqNullSafe(F.col("reloaded")))
    parts = [before.join(after, key, "full").agg(F.count("*").alias("num_rows"), differs.alias("num_different"))]
    names = ["driver_model"]
    for name, frame in lookups(s).items():
        io.write_parquet(frame, f"{folder}/{name}")
        stored = io.read_parquet_table(s.spark, folder, name)
        lost = frame.exceptAll(stored).agg(F.count("*")).scalar()
        parts.append(stored.agg(F.count("*").alias("num_rows")).withColumn("num_different", lost))
        names.append(name)
    return reduce(
        DataFrame.unionByName,
        [p.select(F.lit(n).alias("artefact"), "num_rows", "num_different") for n, p in zip(names, parts)],
    )


def lookups(s):
    entries = log(s)
    return {
        "accuracy_lookup": durable(mon.lookup_from_log(entries)),
        "bias_flags": durable(mon.bias_flags(entries, s.division_days)),
    }


PLANS = {
    "src_csv_tables": csv_tables,
    "src_csv_projected": csv_columns,
    "src_sql": sql_text,
    "src_table_scan": lambda s: s.daily_sales.orderBy("date"),
    "src_optional": optional_tables,
    "sink_csv": csv_sink,
    "sink_table_replace": table_sink,
    "schema_contract": lambda s: contract.check_contract(seven_tables(s)),
    "contract_rows": lambda s: contract.count_broken(seven_tables(s)),
    "audit_row_counts": lambda s: contract.row_counts(seven_tables(s)),
    "model_save_load": artefacts,
}
