"""Readers, writers and stores."""

import gzip
import time

import pytest
from pyspark.sql import functions as F

from tests.compare import rows_of_spark
from tests.conftest import SMALL
from tillwise.operators.contract import check_contract, count_broken, screen
from tillwise.plans import tables
from tillwise.plans.present import present
from tillwise.plans.registry import all_plans
from tillwise.settings import FASHION_STORE
from tillwise.sources import tables as io
from tillwise.sources.schemas import SCHEMAS, conform
from tillwise.sources.scratch import durable, scratch_path, shared_dir
from tillwise.sources.star import StarStore
from tillwise.sources.store import FileStore, save_store

SAME = [
    "div_annual_leaderboard", "eda_monthly_sales", "eda_top_divisions_year", "eda_customer_segments", "win_ytd",
    "rep_store_summary", "rep_segment_mix", "nb_rfm_base", "rfm_segment_summary", "rfm_temp_crosstab", "prep_basket_rollup",
    "build_features", "fc_bias_flags",
]


@pytest.fixture(scope="module")
def saved(spark, store):
    path = scratch_path(spark, "store")
    save_store(store, path)
    return path


@pytest.mark.parametrize("name", SAME)
def test_saved_tables_answer_like_the_source(name, spark, store, saved):
    plan = all_plans()[name]
    assert rows_of_spark(present(plan(FileStore(spark, saved)))) == rows_of_spark(present(plan(store)))


def test_stored_log_and_inventory_are_read(spark, store):
    path = scratch_path(spark, "stored")
    save_store(store, path)
    assert FileStore(spark, path).stored("forecast_log") is None
    log = spark.sql(
        """select date'2000-01-01' forecast_date, date_add(date'2000-01-08', i) target_date, 14 division_code,
        50.00 predicted_sales, 40.00 lower_bound, 60.00 upper_bound, 100.00 actual_sales, 0.5 error_pct,
        concat(date_format(date_add(date'2000-01-08', i), 'EEEE'), '/None') context_flags from (select explode(sequence(0, 69)) i)"""
    )
    io.write_parquet(conform(log, "forecast_log"), f"{path}/forecast_log")
    stock = spark.sql("select date'2000-01-03' week_start_date, 's' sku_id, 5L opening_stock, 2L units_sold")
    io.write_parquet(conform(stock, "inventory"), f"{path}/inventory")
    held, plans = FileStore(spark, path), all_plans()
    assert {float(r.signed_error_pct) for r in plans["fc_signed_error"](held).collect()} == {50.0}
    assert {r.division_code for r in plans["fc_bias_flags"](held).collect()} == {14}
    assert plans["prep_stock_ledger"](held).count() == 1


def test_csv_store_with_its_own_settings(spark, tmp_path):
    """CSV files as a store exports them: text ids, the word None, True and False, empty fields."""
    write = lambda name, text: (tmp_path / f"{name}.csv").write_text(text)
    write("daily_sales", ",".join(c.split()[0] for c in SCHEMAS["daily_sales"].replace("decimal(18,2)", "d").replace("decimal(18,4)", "d").replace("decimal(5,2)", "d").replace("decimal(9,4)", "d").split(",")) + "\n"
          "2024-01-01,Monday,9,True,None,27.50,130000.0,131000.5,1.0077,1600,81.88,2.3,35.6,78600.3,0.6,,False\n"
          "2024-05-21,Tuesday,9,False,Arigato,18.20,210000.0,220000.0,1.0476,2500,88.0,2.2,40.0,136400.0,0.62,,False\n"
          "2025-01-01,Wednesday,9,True,None,27.10,130000.0,150000.0,1.1538,1700,88.24,2.3,38.4,90000.0,0.6,0.145,True\n")
    store = FileStore(spark, str(tmp_path), "csv", FASHION_STORE)
    plans = all_plans()
    impact = {r.event_flag: r.num_days for r in plans["eda_event_impact"](store).collect()}
    assert impact == {"None": 2, "Arigato": 1}
    january = plans["eda_yoy_by_month"](store).first()
    assert (float(january.sales_first), float(january.sales_second), january.yoy_pct_change) == (131000.5, 150000.0, 14.5)
    assert [r.yoy_pct for r in store.daily_sales.orderBy("date").collect()][:2] == [None, None]
    assert store.daily_sales.where("is_public_holiday").count() == 2


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    (tmp_path / "products.csv").write_text("sku,price\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        io.read_csv_table(spark, str(tmp_path), "products").collect()


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def test_csv_tables_take_little_disk(spark, tmp_path, monkeypatch):
    """The inventory, a row for each SKU and week, is packed; what was shuffled goes with its table; no row is left out."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before, raw = spark.conf.get(key, None), shuffle_files(spark), StarStore(spark, SMALL)
    monkeypatch.setattr(tables, "scratch_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setitem(io.PACKED, "maxRecordsPerFile", 5000)
    sums = tables.csv_tables(raw)
    until = time.time() + 10  # files go in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and spark.conf.get(key, None) == setting
    files = [f.read_bytes() for f in (tmp_path / "csv" / "inventory.csv").glob("part-*")]
    read = [gzip.decompress(f) for f in files]
    assert sum(map(len, files)) < 0.2 * sum(map(len, read))
    got, rows = {r.table_name: r.num_rows for r in sums.collect()}, [text.count(b"\n") - 1 for text in read]
    assert max(rows) <= 5000 and sum(rows) == got["inventory"]
    for table, frame in tables.seven_tables(raw).items():
        written, back = conform(frame, table), io.read_csv_table(spark, str(tmp_path / "csv"), table)
        assert back.count() == got[table] and back.exceptAll(written).isEmpty() and written.exceptAll(back).isEmpty()


def test_missing_tables_are_empty(spark, tmp_path):
    empty = io.read_optional(spark, str(tmp_path), "forecast_log")
    assert empty.count() == 0 and "context_flags" in empty.columns
    assert io.read_optional_table(spark, "no_such_table", SCHEMAS["products"]).count() == 0


def test_contract_finds_doubles_and_orphans(spark):
    products = spark.createDataFrame([("a",), ("a",), ("b",)], "sku_id string")
    items = spark.createDataFrame([("t1", "a"), ("t1", "zz"), ("t2", "zz")], "transaction_id string, sku_id string")
    baskets = spark.createDataFrame([("t1", "c")], "transaction_id string, customer_id string")
    got = {(r.table_name, r.check_name): r.violations for r in check_contract(
        {"products": products, "transaction_items": items, "transactions": baskets}).collect()}
    assert got[("products", "key sku_id")] == 1
    assert got[("transaction_items", "sku_id in products")] == 1
    assert got[("transaction_items", "transaction_id in transactions")] == 1
    assert got[("transactions", "key transaction_id")] == 0


def test_screen_keeps_broken_rows_aside(spark, tmp_path):
    rows = [("2024-01-01", "2024-01-02", "11", "5.50", None, "x"), ("2024-01-01", "no date", "11", "5.50", "1", "x"),
            (None, "2024-01-02", "eleven", None, "much", "y"), (None, None, None, None, None, None)]
    log = spark.createDataFrame(rows, "forecast_date string, target_date string, division_code string, predicted_sales string, actual_sales string, note string")
    scans = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    got = screen(log.mapInArrow(passed, log.schema), "forecast_log", str(tmp_path / "log"))
    assert scans.value == 4  # each row is read once
    assert {c: n for c, n in got.violations.items() if n} == {
        "null forecast_date": 2, "null target_date": 1, "type target_date": 1, "null division_code": 1, "type division_code": 1,
        "null predicted_sales": 2, "type actual_sales": 1}
    assert [(r.division_code, str(r.predicted_sales), r.actual_sales) for r in got.good.collect()] == [(11, "5.50", None)]
    assert got.good.columns == spark.createDataFrame([], SCHEMAS["forecast_log"]).columns
    bad = {r.note: set(r.broken) for r in got.rejected.collect()}
    assert bad["x"] == {"type target_date"}
    assert bad["y"] == {"null forecast_date", "type division_code", "null predicted_sales", "type actual_sales"}
    counts = count_broken({"forecast_log": log, "products": spark.createDataFrame([], "sku_id string, other int")})
    assert {tuple(r) for r in counts.collect()} == {("forecast_log", 4, 3), ("products", 0, 0)}
    none = screen(spark.createDataFrame([(1,)], "other int"), "products", str(tmp_path / "none"))
    assert none.violations == {} and none.good.count() == 1 and none.rejected.count() == 0


def test_replacing_a_table_is_one_step(spark, tmp_path, monkeypatch):
    name, path = "replaced_in_one_step", str(tmp_path / "t")
    rows = lambda: sorted(r.id for r in spark.table(name).collect())
    versions = lambda: len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")])
    try:
        io.replace_table(spark.range(3), name, path)
        held = spark.table(name)
        io.replace_table(spark.range(5), name, path)
        assert rows() == [0, 1, 2, 3, 4] and versions() == 2
        assert held.count() in (3, 5)  # a reader of the old version still finds its files
        io.replace_table(spark.range(5, 7), name, path)
        assert rows() == [5, 6] and versions() == 2
        with monkeypatch.context() as m:
            m.setattr(io, "_switch", lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                io.replace_table(spark.range(9), name, path)
        assert rows() == [5, 6]
        with pytest.raises(Exception):
            io.replace_table(spark.range(9).select("id", F.raise_error(F.lit("broken")).alias("x")), name, path)
        assert rows() == [5, 6]
        io.replace_table(spark.table(name).withColumn("id", F.col("id") + 1), name, path)  # from its own rows
        assert rows() == [6, 7]
        io.replace_table(spark.range(2).withColumn("more", F.lit("x")), name, path)
        assert rows() == [0, 1] and spark.table(name).columns == ["id", "more"] and versions() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_durable_rows_live_in_the_shared_folder(spark):
    kept = durable(spark.range(10).withColumn("x", F.rand()))
    assert shared_dir(spark).removeprefix("file:") in kept.inputFiles()[0]
    assert kept.collect() == kept.collect()


def test_conform_fills_what_a_source_lacks(spark):
    store = StarStore(spark, SMALL)
    rows = conform(store.division_daily, "division_daily")
    assert rows.columns[-3:] == ["vs_target_pct", "vs_ly_pct", "num_transactions"]
    assert rows.where(F.col("vs_ly_pct").isNotNull()).count() == 0
