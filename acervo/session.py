"""Session defaults and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Cluster-sized values (executor memory, number of
# shuffle partitions) belong to the submit command: AQE coalesces the partitions from there.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method of more than 8,000 bytes of bytecode. Wide projections, such
    # as the 31 cleaned columns of the silver papers, run twice as fast split into smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Repetitive rows shrink tenfold in a shuffle: with 64 MB of it, the defaults, a task sorts gigabytes,
    # and a key of 256 MB is still left whole.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Partitions enough for large inputs whatever the session's number, which else fixes a task's share of the rows that it
    # sorts; AQE joins small ones up to the size above. Beyond 200 the writing task would sort its rows by partition.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    # A table in folders by period needs no sort of its wide rows for them: a task keeps so many files open.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, app: str = "acervo", memory: str = "6g"
) -> SparkSession:
    """Session for tests and the local benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="acervo-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return (configured or _own_folder()).rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder; it is removed when the session ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, with its lineage cut."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows of ``df`` dealt out evenly, for work that costs far more per row than moving the row.

    Splits go by bytes, so a file of short rows is a task or a few, however long each row takes. There
    are as many tasks as the session shuffles into; they stream their rows, so none grows with the input.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
