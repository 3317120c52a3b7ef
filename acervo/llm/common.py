"""What several operators share: reading tables, cutting lineage, non-null columns."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows go to Python workers in batches of about so many bytes: by default they are 10,000 rows, of whole texts tens of
#: MB, which both sides hold more than once. A little less than ``packing.BLOCK``, so that a batch is one block.
BATCH = "1900k"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` as the session names it.

    Only a local session, as in tests, that names none gets one of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder and read back, its lineage cut.

    What was cut survives lost executors. The copy goes with ``release``, or when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _files(spark, path)[0].deleteOnExit(_files(spark, path)[1])
    copy = spark.read.schema(df.schema).parquet(path)
    copy._cut_path = path
    return copy


def release(*copies: DataFrame) -> None:
    """Delete what ``cut`` stored; nothing lazy may still read it."""
    for copy in copies:
        files, path = _files(copy.sparkSession, copy._cut_path)
        files.delete(path, True)


def _files(spark: SparkSession, path: str) -> tuple:
    """(Hadoop file system, path) on the driver's side."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def local_path(uri: str) -> tuple:
    """(pyarrow file system, path) of a URI in the shared folder."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.split(":", 1)[1].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


_at_work: dict[str, Callable[[], None]] = {}


def at_work(owner: str, forget: Callable[[], None] = lambda: None) -> None:
    """Called by an operator's tasks: the Python worker lets go of what other operators keep in it between tasks.

    A worker serves stage after stage, so one stage's tables would stand beside all that later ones need.
    ``forget`` lets go of what this operator keeps.
    """
    for other in [o for o in _at_work if o != owner]:
        _at_work.pop(other)()
    _at_work.setdefault(owner, forget)


def give_back() -> None:
    """What this Python worker no longer uses goes back to the system.

    Arrow and the C library keep freed memory for their own next use, in each idle worker beside the executor's heap.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task``, from batches to batches, that gives its memory back when it ends."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def quiet_threads() -> None:
    """One thread per Spark task: libraries with pools of their own stay out of the neighbours' cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
