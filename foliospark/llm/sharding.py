"""Sharding by fixed virtual slots and a stored, versioned map from slots to shards.

A record's slot is a hash of its id and text, so that groups of equal texts and hot sources spread. Bytes are
aggregated per slot; the map gives each slot to a shard, heaviest first to the lightest shard. A map is a
folder with a table per version; rebalancing and growing edit the latest version by moving single slots.
The map has ``slots`` rows whatever the data: only it comes to the driver, and only it is broadcast.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm import shared

SLOTS = 8192
_MAP = "virtual_slot int, shard int"


def records(docs: DataFrame, slots: int = SLOTS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``; a null text has size 1 and checksum 0."""
    text = F.encode(F.coalesce(F.col(text_column), F.lit("")), "UTF-8")
    return docs.select(F.col(id_column).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       F.pmod(F.xxhash64(F.col(id_column), F.crc32(text)), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_loads(found: DataFrame) -> list[tuple[int, int, int]]:
    """Slot, bytes and rows; at most one row for each slot."""
    return [tuple(r) for r in found.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect()]


def balanced(loads: dict[int, int], slots: int, shards: int) -> dict[int, int]:
    """Every slot to a shard: heaviest slot first, each to the shard with the fewest bytes so far."""
    heap = [(0, shard) for shard in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
        size, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (size + loads.get(slot, 0), shard))
    return out


def rebalanced(current: dict[int, int], loads: dict[int, int], shards: int, tolerance: float = 0.001) -> dict[int, int]:
    """The map edited for new loads or more shards: slots move from the fullest to the emptiest shard.

    Each move lessens the difference between its two shards; moves end when no shard is further than
    ``tolerance`` of the mean from it, or no slot fits. Slots that do not move keep their shard.
    """
    out, held = dict(current), {shard: set() for shard in range(shards)}
    total = dict.fromkeys(held, 0)
    for slot, shard in out.items():
        held[shard].add(slot)
        total[shard] += loads.get(slot, 0)
    mean = sum(total.values()) / shards
    while True:
        full, empty = max(total, key=lambda s: (total[s], -s)), min(total, key=lambda s: (total[s], s))
        gap = total[full] - total[empty]
        if max(total[full] - mean, mean - total[empty]) <= tolerance * mean:
            return out
        wanted = min(total[full] - mean, mean - total[empty]) or gap / 2
        fitting = [s for s in held[full] if 0 < loads.get(s, 0) < gap]
        if not fitting:
            return out
        slot = min(fitting, key=lambda s: (abs(loads[s] - wanted), s))
        held[full].remove(slot)
        held[empty].add(slot)
        out[slot] = empty
        total[full] -= loads[slot]
        total[empty] += loads[slot]


def save(spark: SparkSession, folder: str, version: int, shard_of: dict[int, int]) -> None:
    """One version of the map; a version that exists is not written again."""
    spark.createDataFrame(sorted(shard_of.items()), _MAP).coalesce(1).write.parquet(f"{folder}/version={version}")


def load(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(_MAP).parquet(f"{folder}/version={version}")


def place(found: DataFrame, slot_map: DataFrame, loads: list[tuple[int, int, int]]) -> DataFrame:
    """Records with ``shard`` and ``slot``, their place within the shard from 0 without gaps.

    Places count slot by slot: a slot's first place comes from the row counts of the slots before it, so
    no window spans a shard.
    """
    spark = found.sparkSession
    counts = spark.createDataFrame([(s, n) for s, _, n in loads], "virtual_slot int, n long")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(counts, "virtual_slot").withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .select("virtual_slot", "shard", "before")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    # The map has a row for each slot at most: its size is bounded whatever the data.
    return (found.withColumn("place", F.row_number().over(within) - 1)
            .join(F.broadcast(starts), "virtual_slot")
            .withColumn("slot", (F.col("before") + F.col("place")).cast("long")).drop("before", "place"))


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, folder: str | None = None,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, next_shard, map_version``.

    Shards are near equal in bytes (law ``bytes``, ``grown_shard`` null). The map is stored as version 1 in
    ``folder`` (default: a new one in the shared folder), and as version 2 edited for one more shard;
    ``next_shard`` is the shard under version 2. A null text has size 1, null ids hash like any value, repeated
    rows get places of their own, an empty table gives an empty one, other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared.folder(spark)}/slot-map-{uuid.uuid4().hex}"
    found = records(docs, slots, id_column, text_column)
    loads = slot_loads(found)
    sizes = {slot: size for slot, size, _ in loads}
    first = balanced(sizes, slots, shards)
    save(spark, folder, 1, first)
    save(spark, folder, 2, rebalanced(first, sizes, shards + 1))
    grown = load(spark, folder, 2).withColumnRenamed("shard", "next_shard")
    return (place(found, load(spark, folder, 1), loads).join(F.broadcast(grown), "virtual_slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard",
                    F.lit(1).alias("map_version")))
