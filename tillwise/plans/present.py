"""Output form of query results."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    """Fixed-point decimals as doubles and dates as ISO text, the forms readers of the results expect."""

    def shown(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return col.cast("string").alias(field.name)
        return col

    return df.select([shown(f) for f in df.schema.fields])
