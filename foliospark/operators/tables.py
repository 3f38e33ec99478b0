"""Small fixed tables."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant table whose exact size Catalyst knows, so that joins with it
    are broadcast because they fit, not because they are told to."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema)


def union_by(key: str, *parts: DataFrame) -> DataFrame:
    """Union of tables that is going to be grouped by ``key``.

    Spark 4.1 takes over the partitioning of a union's children when they agree
    at planning time; when adaptive execution changes one of them afterwards, a
    group by that trusts it gives a key twice. The shuffle that the grouping
    needs is therefore made explicit here, once, after the union.
    """
    return reduce(lambda a, b: a.unionByName(b), parts).repartition(key)


# Bits of a key filter, and of one of its rows: 8 MB in 2048 rows, whatever the number of keys.
FILTER_BITS, ROW_BITS = 1 << 26, 8 * 4096


def split_by_keys(rows: DataFrame, keys: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` without any key in ``keys``, and those that may have one.

    The keys' hashes are set in a bitmap of fixed size, which is broadcast; the test is a built-in expression. So large
    rows whose key is not there are not shuffled to find that out. The second part has all rows with a key and, by
    chance, some without.
    """
    position = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    bits = (keys.select(position.alias("_at")).groupBy((F.col("_at") / ROW_BITS).cast("long").alias("_row"))
            .agg(F.bitmap_construct_agg(F.col("_at") % ROW_BITS).alias("_bits")))
    marked = rows.withColumn("_at", position).withColumn("_row", (F.col("_at") / ROW_BITS).cast("long"))
    at = (F.col("_at") % ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))
    tested = marked.join(F.broadcast(bits), "_row", "left").withColumn("_hit", hit)        # at most 2048 rows of 4 KB
    return (tested.where("NOT _hit").select(rows.columns), tested.where("_hit").select(rows.columns))
