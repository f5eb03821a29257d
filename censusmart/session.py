"""Session settings the marts rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Results depend on the time zone; the rest are Spark's own answers to size and skew.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when a later aggregation then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

def configure(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session, the same everywhere.

    ``initial_partitions`` is the number that shuffles start with. AQE merges small partitions but never
    splits an evenly large one, so big inputs want several per core instead of the default.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if initial_partitions is not None:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("censusmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    The folder is the one named in ``spark.checkpoint.dir``, or one in the warehouse, which is shared as
    well, where that setting is absent. The rows survive the loss of executors.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_checkpoints")
    return df.checkpoint()
