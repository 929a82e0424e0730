"""The retail tables an operator can ask for."""

from collections.abc import Callable
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.settings import Settings
from tillwise.sources.scratch import durable
from tillwise.sources.tables import exists, read_csv_table, read_parquet_table, write_parquet


# derived tables by session, state of the input files, settings and name; the session is held so that its key stays its own
_SHARED: dict[tuple, tuple[SparkSession, DataFrame]] = {}


def state_of_files(spark: SparkSession, paths: list[str]) -> tuple | None:
    """What changes when a file is added, removed or rewritten: read from a listing, never from contents. None if a path is missing."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    entry = F.xxhash64("path", "length", "modificationTime")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(entry), F.max("modificationTime")).first())


class Store:
    """Base of all stores: subclasses provide the fact and dimension tables.

    `division_days`, `sales_days` and `dense_days` are the small roll-ups (one row per
    day, or per day and division) that every time-series job starts from. Their size
    follows the calendar, not the number of baskets. They are written once, and again when the input files change.
    """

    spark: SparkSession
    settings: Settings = Settings()

    @cached_property
    def _kept(self) -> dict[str, DataFrame]:
        return {}

    def input_paths(self) -> list[str]:
        """Files that all derived tables follow from; none if the store cannot tell."""
        return []

    @cached_property
    def _state(self) -> tuple | None:
        paths = self.input_paths()
        state = state_of_files(self.spark, paths) if paths else None
        return state and (type(self).__qualname__, *paths, *state)

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table that is written once and then shared by all queries of the session on the same files."""
        if name not in self._kept:
            key = (id(self.spark), self._state, repr(self.settings), name)
            if self._state is None or key not in _SHARED:
                self._kept[name] = durable(build())
                if self._state is None:
                    return self._kept[name]
                _SHARED[key] = (self.spark, self._kept[name])
            self._kept[name] = _SHARED[key][1]
        return self._kept[name]

    def stored(self, table: str) -> DataFrame | None:
        """A result table that the source already holds, else None."""
        return None

    @cached_property
    def baskets(self) -> DataFrame:
        """When, who and how much of every basket; a source may give these without any join."""
        return self.transactions.select("transaction_id", "date", "customer_id", "total_amount")

    @cached_property
    def visits(self) -> DataFrame:
        """Time stamps of store traffic."""
        return self.transactions.select(F.col("timestamp").alias("ts"))

    @cached_property
    def promo_lines(self) -> DataFrame:
        """Basket lines at list price with their promotion flag and margin ratio."""
        items = self.transaction_items.select(
            "transaction_id", "sku_id", "quantity", "unit_price",
            (F.col("unit_price") != F.col("discounted_price")).alias("promo"),
        )
        return items.join(self.products.select("sku_id", "gp_ratio"), "sku_id")

    @cached_property
    def dated_items(self) -> DataFrame:
        """Basket lines with the day they count for; no join where the lines carry one."""
        if "date" in self.transaction_items.columns:
            return self.transaction_items
        return self.transaction_items.join(self.transactions.select("transaction_id", "date"), "transaction_id", "left")

    @cached_property
    def item_dates(self) -> DataFrame:
        """The dates of the basket lines and nothing else."""
        return self.dated_items.select("date")

    @cached_property
    def division_days(self) -> DataFrame:
        columns = ["date", "division_code", "division_name", "department", "sales_amt", "gp_amt", "gp_ratio"]
        return self.keep("division_days", lambda: self.division_daily.select(*columns))

    @cached_property
    def sales_days(self) -> DataFrame:
        return self.keep("sales_days", lambda: self.daily_sales)

    @cached_property
    def dense_days(self) -> DataFrame:
        """Every division on every day between the first and last sale, zero where nothing sold."""
        sold = self.division_days
        first = sold.agg(F.min("date")).scalar()
        last = sold.agg(F.max("date")).scalar()
        spine = (
            sold.groupBy("division_code", "division_name", "department")
            .agg(F.count("*").alias("_n"))
            .drop("_n")
            .withColumn("date", F.explode(F.sequence(first, last)))
        )
        zero = F.lit(0).cast("decimal(18,2)")
        return spine.join(
            sold.select("date", "division_code", "sales_amt", "gp_amt", "gp_ratio"),
            ["date", "division_code"],
            "left",
        ).select(
            "date", "division_code", "division_name", "department",
            F.coalesce("sales_amt", zero).alias("sales_amt"),
            F.coalesce("gp_amt", zero).alias("gp_amt"),
            "gp_ratio",
        )


class FileStore(Store):
    """Retail tables kept as files, one CSV or Parquet dataset per table."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", settings: Settings = Settings()):
        self.spark, self.path, self.fmt, self.settings = spark, path, fmt, settings

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_") or table not in TABLE_NAMES:
            raise AttributeError(table)
        reader = read_csv_table if self.fmt == "csv" else read_parquet_table
        return reader(self.spark, self.path, table)

    def stored(self, table: str) -> DataFrame | None:
        if table == "trees":
            path = f"{self.path}/models/trees"
            return self.spark.read.parquet(path) if exists(self.spark, path) else None
        suffix = ".csv" if self.fmt == "csv" else ""
        return getattr(self, table) if exists(self.spark, f"{self.path}/{table}{suffix}") else None


TABLE_NAMES = (
    "products", "customers", "daily_sales", "division_daily",
    "transactions", "transaction_items", "inventory", "forecast_log",
)


def save_store(store: Store, path: str) -> None:
    """Write a store's tables as Parquet once, so that later queries start from the roll-ups.

    Baskets are laid out by month, which lets date ranges skip files.
    """
    for table in TABLE_NAMES[:6]:
        frame = getattr(store, table)
        if table == "transactions":
            write_parquet(frame.withColumn("month", F.date_format("date", "yyyy-MM")), f"{path}/{table}", ["month"])
        else:
            write_parquet(frame, f"{path}/{table}")
