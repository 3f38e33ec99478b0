"""Tables in the folder all executors share, and filters of a fixed size."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bits of an id filter: 8 MB, whatever the number of ids.
FILTER_BITS = 1 << 26
_BITMAP_BITS = 8 * 4096


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset (tests on one machine) a temporary folder becomes it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="foliospark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage and its shuffle files end here."""
    spark, path = df.sparkSession, f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``stored`` in buckets of ``key``, as many as a shuffle has partitions: grouping by it reads them without another shuffle."""
    spark, number = df.sparkSession, uuid.uuid4().hex
    path, table = f"{folder(spark)}/{name}-{number}", f"foliospark_{number}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.stored_at, out.stored_as = path, table
    return out


def remove(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` and ``stored_by`` that nothing reads any more."""
    for table in tables:
        if getattr(table, "stored_as", None):
            table.sparkSession.sql(f"DROP TABLE {table.stored_as}")
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def integral(df: DataFrame, column: str) -> None:
    """Refuse ids that are not whole numbers."""
    kind = df.schema[column].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{column} has to be a whole number, not {kind}")


def bytes_per_batch(spark: SparkSession, limit: int = 16 << 20) -> None:
    """Bound Arrow batches by bytes as well, so that very long texts do not add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


_slot: list = []


def worker_state(make, value):
    """``make(value)``, kept by a Python worker between its tasks; ``value`` is a broadcast value or a number.

    A worker keeps the latest one only: workers serve one stage after another, and what each would keep adds up.
    """
    if not (_slot and _slot[0] is make and (_slot[1] is value or (isinstance(value, int) and _slot[1] == value))):
        _slot.clear()
        _slot.extend((make, value, make(value)))
    return _slot[2]


def forget() -> None:
    """Let go of what an earlier operator left in this Python worker."""
    _slot.clear()


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits with the hash of each id set; false hits are possible, misses are not.

    Built by aggregation on the executors; the driver receives at most 2048 rows of 4 KB.
    """
    position = filter_position(F.col(column))
    parts = (ids.where(F.col(column).isNotNull()).select(position.alias("bit"))
             .groupBy((F.col("bit") / _BITMAP_BITS).cast("long").alias("part"))
             .agg(F.bitmap_construct_agg(F.col("bit") % _BITMAP_BITS).alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, bits in parts:
        out[part * 4096:part * 4096 + len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    return out


def filter_position(column):
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def in_filter(bits: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (bits[positions >> 3] >> (positions & 7).astype(np.uint8)) & 1 == 1
