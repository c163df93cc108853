"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import functools
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import ensure_checkpoint_dir

# Rows per Arrow batch: long texts stay a few dozen MB per batch in a Python worker.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch; whole texts of any length still pass."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


# Paths of the tables that this process has written, oldest first.
_WRITTEN: list[str] = []


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/cadenza-llm/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: cuts lineage,
    survives lost executors, and takes less disk than the row format of ``checkpoint()``."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or folder wherever Spark can write."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def tidy(operator):
    """Operator whose tables go when its result is written: the result is a table too, read back, and only that stays
    (until ``clean_up``). An operator that ends with an error leaves its tables for ``clean_up``."""
    @functools.wraps(operator)
    def run(*args, **options):
        mark = len(_WRITTEN)
        out = operator(*args, **options)
        spark = out.sparkSession
        out = materialise(out, operator.__name__)
        for path in _WRITTEN[mark:-1]:
            remove(spark, path)
        del _WRITTEN[mark:-1]
        return out

    return run


@contextlib.contextmanager
def passing_tables(spark: SparkSession):
    """Delete the tables that operators write inside the block when it ends: for jobs that write their own result there. A
    block that ends with an error leaves them for ``clean_up``."""
    mark = len(_WRITTEN)
    yield
    for path in _WRITTEN[mark:]:
        remove(spark, path)
    del _WRITTEN[mark:]


def clean_up(spark: SparkSession) -> None:
    """Delete every table that operators have left in the checkpoint folder for this application, results too."""
    remove(spark, _folder(spark))
    _WRITTEN.clear()


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit xxhash of each word."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def release() -> None:
    """Give freed memory back to the system, so that a worker that the next stage reuses starts small."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def frees(scan):
    """A partition function that gives its memory back at its end."""
    def run(batches):
        try:
            yield from scan(batches)
        finally:
            release()

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wraps modulo 2^64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
