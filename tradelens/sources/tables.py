"""Access to the five canonical tables.

Analyses ask for a table *with the columns they use*: ``tables.orders("status", "total_amount")``.
For plain files that is a projection; for tables that must be derived from others it also
tells the source which joins it can leave out altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.sources.schema import PRIMARY_KEYS, SCHEMAS, TABLE_NAMES

# Position of a line within its order. Any ordered column will do; item_id is the usual one.
LINE_SEQ = "line_seq"

# Header CSV; dates as yyyy-MM-dd; texts with quotes and line ends come back as they were; a row
# that does not parse fails the read.
CSV_WRITE = {"header": "true", "dateFormat": "yyyy-MM-dd", "escape": '"',
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_READ = CSV_WRITE | {"mode": "FAILFAST", "enforceSchema": "false", "multiLine": "true"}


class Tables:
    """Canonical tables held as DataFrames, e.g. read from Parquet, CSV or JDBC."""

    def __init__(self, frames: dict[str, DataFrame]):
        self._frames = frames
        self._counts: dict[str, int] = {}

    # -- sources ---------------------------------------------------------------------------
    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Tables:
        return cls({name: spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}")
                    for name in TABLE_NAMES})

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str) -> Tables:
        return cls({name: spark.read.options(**CSV_READ).schema(SCHEMAS[name]).csv(f"{folder}/{name}")
                    for name in TABLE_NAMES})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Tables:
        return cls({name: spark.table(f"{database}.{name}") for name in TABLE_NAMES})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, parts: int = 64, **options: str) -> Tables:
        """Read from a database, split into ``parts`` ranges of each table's key."""
        def load(name: str) -> DataFrame:
            key = PRIMARY_KEYS[name]
            base = spark.read.format("jdbc").option("url", url).options(**options)
            low, high = base.option(
                "query", f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {name}").load().first()
            return (base.option("dbtable", name).option("partitionColumn", key)
                    .option("lowerBound", low or 0).option("upperBound", (high or 0) + 1)
                    .option("numPartitions", parts).load().to(SCHEMAS[name]))
        return cls({name: load(name) for name in TABLE_NAMES})

    # -- tables ----------------------------------------------------------------------------
    # Keys that the source makes up itself when they are read, so that they cannot be wrong.
    generated: frozenset[tuple[str, str]] = frozenset()

    def columns(self, name: str) -> list[str]:
        return self._frames[name].columns

    def _pick(self, name: str, columns: tuple[str, ...]) -> DataFrame:
        frame = self._frames[name]
        return frame.select(*columns) if columns else frame

    def customers(self, *columns: str) -> DataFrame:
        return self._pick("customers", columns)

    def products(self, *columns: str) -> DataFrame:
        return self._pick("products", columns)

    def raw_orders(self, *columns: str, statuses: list[str] | None = None) -> DataFrame:
        """Orders as stored, with missing totals left missing; of some statuses if given."""
        df = self._frames["orders"]
        if statuses is not None:
            df = df.where(F.col("status").isin(statuses))
        return df.select(*columns) if columns else df

    def orders(self, *columns: str, statuses: list[str] | None = None) -> DataFrame:
        """Orders with missing totals read as zero; every analysis but the null audit uses this."""
        return fill_totals(self.raw_orders(*columns, statuses=statuses))

    def order_items(self, *columns: str) -> DataFrame:
        if LINE_SEQ in columns:
            wanted = [F.col("item_id").alias(LINE_SEQ) if c == LINE_SEQ else F.col(c)
                      for c in columns]
            return self._frames["order_items"].select(*wanted)
        return self._pick("order_items", columns)

    def returns(self, *columns: str) -> DataFrame:
        return self._pick("returns", columns)

    def table(self, name: str, *columns: str) -> DataFrame:
        return getattr(self, name)(*columns)

    def smallest(self, name: str) -> DataFrame:
        """One row: the smallest value of every column, as text."""
        names = self.columns(name)
        return self.table(name, *names).agg(*[F.min(c).cast("string").alias(c) for c in names])

    # -- sizes -----------------------------------------------------------------------------
    def row_count(self, name: str) -> int:
        """Stored rows; on Parquet this reads footers only."""
        if name not in self._counts:
            self._counts[name] = self._frames[name].count()
        return self._counts[name]

    def input_bytes(self) -> int:
        """Size of the stored tables as Spark estimates it from the files."""
        return sum(int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
                   for frame in self._frames.values())


def fill_totals(orders: DataFrame) -> DataFrame:
    if "total_amount" not in orders.columns:
        return orders
    kind = orders.schema["total_amount"].dataType
    filled: Column = F.coalesce("total_amount", F.lit(0).cast(kind))
    return orders.withColumn("total_amount", filled)
