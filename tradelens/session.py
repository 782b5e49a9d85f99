"""Session settings the jobs rely on, and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; all keep results unchanged. The forced skew split matters when a hot
# order or customer meets a join whose output is grouped by the same key again.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "tradelens", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_USUAL = "tradelens.shuffle.usualWidth"
BYTES_PER_PARTITION = 256 * 1024 * 1024
FEW_ROWS, MANY_ROWS = 100_000, 20_000_000  # rows a range should have at least, at most
GROUPED_ROWS = 500_000  # rows of a task that holds a group for nearly each of them


def shuffle_width(spark: SparkSession) -> int:
    """Partitions a shuffle starts with; AQE merges small ones afterwards."""
    return int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def range_width(spark: SparkSession, rows: int | None = None) -> int:
    """Ranges to cut ``rows`` rows into: the shuffle width, unless that is far off for the rows."""
    width = shuffle_width(spark)
    if rows is None:
        return width
    return max(min(width, -(-rows // FEW_ROWS)), -(-rows // MANY_ROWS), 1)


def grouped_width(spark: SparkSession, rows: int, copies: int = 1) -> int:
    """Partitions for ``rows`` rows, each taken ``copies`` times, that a task groups in memory.

    Small columns shrink to few bytes in a shuffle, so partitions merged by bytes hold ever more rows.
    """
    return max(min(shuffle_width(spark), -(-rows // FEW_ROWS)), -(-rows * copies // GROUPED_ROWS), 1)


def widen_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles wide enough for the input, never narrower than the session had it at first.

    A query on little input after one on much starts as narrow as before again.
    """
    usual = spark.conf.get(_USUAL, None)
    if usual is None:
        usual = str(shuffle_width(spark))
        spark.conf.set(_USUAL, usual)
    wanted = max(-(-input_bytes // BYTES_PER_PARTITION), int(usual))
    if wanted != shuffle_width(spark):
        spark.conf.set(_INITIAL, str(wanted))


def _shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only where everything is local."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tradelens-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there goes away with the session."""
    path = f"{_shared_folder(spark)}/{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where several passes must see the very same rows in the very same ranges, which a
    recomputed range shuffle would not promise. The table outlives lost executors and goes away
    with the session.
    """
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
