"""Stored tables: replaced as a whole or by partition, and checked before they are seen.

``replace`` writes beside the old data, reads that back, compares rows and checksum with what went
in, adds a manifest, and only then swaps the folders; whatever fails before leaves the old data as
it is. ``fill_stored_totals`` is the update of missing totals: it rewrites the months that have one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tradelens.sources.schema import SCHEMAS
from tradelens.sources.tables import CSV_READ, CSV_WRITE, Tables, fill_totals

MANIFEST = "_manifest.json"  # names with an underscore are no data to Spark
MONTH = "order_month"


class ReadBackError(RuntimeError):
    """What was written does not come back as it was."""


def canonical(tables: Tables, name: str) -> DataFrame:
    """A table in the columns and types of the schema; columns the source lacks are empty."""
    present = set(tables.columns(name))
    rows = tables.raw_orders() if name == "orders" else tables.table(name)
    return rows.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SCHEMAS[name]])


def _figures(df: DataFrame) -> list[Column]:
    """Rows and a sum over all values that does not depend on their order."""
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
            .alias("checksum")]


def read(spark: SparkSession, path: str, kind: str, schema: StructType) -> DataFrame:
    if kind == "csv":
        return spark.read.options(**CSV_READ).schema(schema).csv(path)
    if kind == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unknown format: {kind}")


class _Folders:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._spark = spark

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path))
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        text = self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text


def replace(df: DataFrame, path: str, kind: str = "parquet") -> dict:
    """Put ``df`` in the place of what ``path`` holds; returns the manifest.

    Rows and checksum are taken while the rows are written, so ``df`` runs once. The swap is two
    renames: a reader may find no folder between them, never a part of one. CSV has no empty texts;
    they become NULL.
    """
    if kind == "csv":
        df = df.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name) if f.dataType == StringType()
                         else F.col(f.name) for f in df.schema])
    spark = df.sparkSession
    folders, mark = _Folders(spark, path), uuid.uuid4().hex
    staged, old = f"{path}.staged-{mark}", f"{path}.old-{mark}"
    try:
        seen = Observation("written")
        writer = df.observe(seen, *_figures(df)).write
        if kind == "csv":
            writer.options(**CSV_WRITE).csv(staged)
        elif kind == "parquet":
            writer.parquet(staged)
        else:
            raise ValueError(f"unknown format: {kind}")
        went_in = seen.get
        back = read(spark, staged, kind, df.schema)
        came_back = back.agg(*_figures(back)).first().asDict()
        if went_in != came_back:
            raise ReadBackError(f"{path}: wrote {went_in}, read {came_back}")
        manifest = {**came_back, "kind": kind, "schema": json.loads(df.schema.json())}
        folders.write(f"{staged}/{MANIFEST}", json.dumps(manifest))
        if folders.exists(path):
            folders.move(path, old)
        try:
            folders.move(staged, path)
        except BaseException:
            if folders.exists(old):
                folders.move(old, path)
            raise
        folders.remove(old)
        return manifest
    finally:
        folders.remove(staged)


def verify(spark: SparkSession, path: str) -> dict:
    """The manifest of a stored dataset, if the data still agree with it."""
    manifest = json.loads(_Folders(spark, path).read(f"{path}/{MANIFEST}"))
    df = read(spark, path, manifest["kind"], StructType.fromJson(manifest["schema"]))
    found = df.agg(*_figures(df)).first().asDict()
    if any(manifest[name] != value for name, value in found.items()):
        raise ReadBackError(f"{path}: manifest {manifest['rows']} rows, read {found}")
    return manifest


def store_orders(tables: Tables, path: str) -> None:
    """The orders as they are, missing totals included, partitioned by month."""
    months = F.date_format("order_date", "yyyy-MM").alias(MONTH)
    canonical(tables, "orders").select("*", months).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def stored_orders(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType([*SCHEMAS["orders"]]).add(MONTH, "string")
    return spark.read.schema(schema).parquet(path)


def fill_stored_totals(spark: SparkSession, path: str) -> list[str | None]:
    """Set missing totals of stored orders to zero; returns the months that were rewritten (None: no date).

    Dynamic partition overwrite: only months with a missing total are read and written again, all
    others keep their files. To the driver goes a row for each such month.
    """
    stored = stored_orders(spark, path)
    hit = stored.where("total_amount IS NULL").select(MONTH).distinct()
    months = sorted((row[MONTH] for row in hit.collect()), key=str)
    if months:
        dated = F.col(MONTH).isin([m for m in months if m is not None])
        chosen = dated | F.col(MONTH).isNull() if None in months else dated
        fill_totals(stored.where(chosen)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return months
