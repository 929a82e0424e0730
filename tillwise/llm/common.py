"""Small helpers shared by the operators of this folder."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tillwise.sources import scratch

# for the writing of one table: its shuffle files go at once, and Python workers hold few texts at a time
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Write to the shared folder and go on from the written table.

    The shuffle files behind the written table are not needed again, so Spark may delete them at once.
    """
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in _WRITING}
    for key, value in _WRITING.items():
        conf.set(key, value)
    try:
        return scratch.durable(df)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose column holds about `most` bytes; a longer row comes alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < len(sizes):
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # the worker stays for later tasks


class Memo(dict):
    """A bounded cache: computes a missing entry, and starts anew when full."""

    def __init__(self, compute, most: int = 150_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.compute(key)
        return value


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose doc_id is not among ids; null is an id like any other."""
    out = ids.select(ids["doc_id"].alias("_out_id")).distinct()
    return docs.join(out, docs["doc_id"].eqNullSafe(out["_out_id"]), "left_anti")
