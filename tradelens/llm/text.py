"""What the operators share: tables, words, batches of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

WORD = r"[^\x20\x09-\x0D]+"  # what bytes.split() without arguments takes as a word
SLICE_BYTES = 2 << 20
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000,
                "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shards_for(df: DataFrame, bytes_each: int = 8 << 20) -> int:
    """Groups to cut the rows of ``df`` into: several per shuffle partition, more for large input."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * width, min(-(-size // bytes_each), 1 << 30))


def _number(setting: str) -> int:
    """A count or a size in bytes, as Spark writes it."""
    value, unit = re.fullmatch(r"(-?[0-9]+)([bkmg]?)b?", setting.strip().lower()).groups()
    return int(value) << {"k": 10, "m": 20, "g": 30}.get(unit, 0)


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of bounded size, whatever the session's usual ones are."""
    for name, most in ARROW_LIMITS.items():
        if not 0 < _number(spark.conf.get(name)) <= most:
            spark.conf.set(name, str(most))


def texts(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as binary, nulls as empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return column.fill_null(b"") if column.null_count else column


def slices(batches: Iterable[pa.RecordBatch], name: str = "text",
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Every batch cut into runs of rows of about ``size`` bytes of text; a longer text stands alone."""
    for batch in batches:
        first, held = 0, 0
        for i, length in enumerate(pc.binary_length(texts(batch, name)).to_pylist()):
            if held and held + length > size:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += length
        if batch.num_rows > first:
            yield batch.slice(first)
