"""Session helpers of the llm operators: shared storage, lineage cuts and bounded Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of one Arrow batch handed to Python; long texts make a batch small by its bytes.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20
_owned: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a local session (tests) gets a temporary one, and any other raises ValueError."""
    context = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not place:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir is unset, and executors share no local folder")
        place = tempfile.mkdtemp(prefix="quillstone-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(place)
    return place


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished steps now; it works on what the driver has collected as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut: computed once, kept in the shared folder, so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    release(df.sparkSession)
    return df.checkpoint()


def table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as Parquet in the shared folder and read again, with the path. For wide rows, of which later steps read few columns."""
    spark = df.sparkSession
    path = own_path(spark, name)
    release(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def own_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver exits if not before."""
    if not _owned:
        atexit.register(_delete_all)
    path = f"{shared_dir(spark).rstrip('/')}/quillstone-{name}-{uuid.uuid4().hex}"
    _owned[path] = spark
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a table made by table() or at own_path()."""
    _owned.pop(path, None)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    release(spark)


def _delete_all() -> None:
    for path, spark in list(_owned.items()):
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            pass


def free_prefix(columns: list[str]) -> str:
    """Underscores, two at least, with which no column's name begins: names of additional columns that clash with none."""
    prefix = "__"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def arrow_map(df: DataFrame, fn, schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """df.mapInArrow with batches bounded in rows and bytes. These limits are settings of the session and stay set. rows: for narrow rows that are computed before the next call."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches):
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns this worker's free memory to the system: it lives on after its partition, beside workers of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)
