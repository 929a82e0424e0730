"""Row counts, key and reference checks over the retail tables, and checks of each row's values.

A row breaks the contract where a column that must hold a value is null (`null x`), or where a value does not
fit the column's type (`type x`), as in files read as text. Columns that a frame lacks are not checked, further
columns are ignored. All checks of a table are expressions of one pass over it.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.sources.schemas import KEYS, OPTIONAL, REFERENCES, SCHEMAS, conform


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("num_rows")).select(F.lit(t).alias("table_name"), "num_rows") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def check_contract(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of violations of each key and reference.

    Both sides of a reference are reduced to their distinct ids first, so a hot id costs no
    more than any other.
    """
    checks = []
    for table, key in KEYS.items():
        if table in tables:
            twice = tables[table].groupBy(*key).count().where(F.col("count") > 1)
            checks.append(_violations(twice, table, f"key {', '.join(key)}"))
    for table, column, other, other_column in REFERENCES:
        if table in tables and other in tables:
            used = tables[table].select(F.col(column).alias("id")).where(F.col("id").isNotNull()).distinct()
            known = tables[other].select(F.col(other_column).alias("id"))
            checks.append(_violations(used.join(known, "id", "left_anti"), table, f"{column} in {other}"))
    return reduce(DataFrame.unionByName, checks)


def _violations(bad: DataFrame, table: str, check: str) -> DataFrame:
    return bad.agg(F.count("*").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations"
    )


class Screened(NamedTuple):
    """Rows that keep the contract, in its columns and types; the others as they came, with the checks they break
    as `broken`; and the number of violations by check."""

    good: DataFrame
    rejected: DataFrame
    violations: dict[str, int]


def row_checks(df: DataFrame, table: str) -> dict[str, Column]:
    """Whether a row of df breaks each check of the table; never null."""
    checks = {}
    for field in T.StructType.fromDDL(SCHEMAS[table]).fields:
        if field.name not in df.columns:
            continue
        value = F.col(f"`{field.name}`")
        if field.name not in OPTIONAL.get(table, []):
            checks[f"null {field.name}"] = value.isNull()
        if df.schema[field.name].dataType != field.dataType:
            checks[f"type {field.name}"] = value.isNotNull() & value.try_cast(field.dataType).isNull()
    return checks


def count_broken(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, num_rows and num_broken, the rows that break a check; one pass a table."""
    parts = []
    for table, df in tables.items():
        broken = reduce(Column.__or__, row_checks(df, table).values(), F.lit(False))
        counts = df.agg(F.count("*").alias("num_rows"), F.count_if(broken).alias("num_broken"))
        parts.append(counts.select(F.lit(table).alias("table_name"), "num_rows", "num_broken"))
    return reduce(DataFrame.unionByName, parts)


def screen(df: DataFrame, table: str, path: str) -> Screened:
    """Write df once to `path`, marked with the checks each row breaks, and split it by the mark.

    The violations are counted while it is written, so the source is read once. Keys and references
    hold between rows: see `check_contract`.
    """
    checks = row_checks(df, table)
    names = {check: f"c{i}" for i, check in enumerate(checks)}
    seen = Observation()
    broken = F.filter(F.array(*(F.when(bad, F.lit(check)) for check, bad in checks.items())), lambda c: c.isNotNull())
    broken = broken if checks else F.array().cast("array<string>")
    counts = [F.count_if(bad).alias(names[check]) for check, bad in checks.items()]
    marked = df.observe(seen, F.count("*").alias("num_rows"), *counts).select("*", broken.alias("broken"))
    marked.write.parquet(path)
    got = seen.get
    marked = df.sparkSession.read.schema(marked.schema).parquet(path)
    return Screened(
        conform(marked.where(F.size("broken") == 0), table),
        marked.where(F.size("broken") > 0),
        {check: got[name] for check, name in names.items()},
    )
