"""Near-duplicate vectors by an epsilon grid order join.

Vectors of unit length with cosine c are at the distance sqrt(2 - 2c), so pairs above a cosine lie within epsilon.
Vectors are turned to their principal axes and sorted by the epsilon cells of the leading ones; ties follow the
first coordinate, so a full cell can be cut anywhere. The sequence is cut into intervals of ``BLOCK`` vectors with
a bounding box each. Intervals are joined recursively: pairs of groups of intervals whose boxes are further than
epsilon from each other are dropped, the others are opened, down to pairs of intervals. Two intervals meet first
with codes of a byte for each leading coordinate; only vectors with a partner that the codes cannot rule out are sent
whole, and their cosines are computed in double precision.

Turning keeps distances, so no pair is lost whatever the axes are; they are fitted on a bounded sample.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import shared
from foliospark.llm.components import components

COSINE = 0.95
BLOCK = 256
FAN = 16               # intervals, or groups of them, in a group of the next level
CELL_DIMENSIONS = 8
# Vectors the axes are fitted on, at most: the first in order of a hash.
SAMPLE = 20_000
# Leading coordinates that have a code, and its step; codes differ from coordinates by less than a step.
CODED, STEP = 16, 0.01
_SLACK = 1e-6


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, v``: vectors with an id that are not null, not zero, and have only finite components."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True))
                   & F.exists(v, lambda x: x != 0)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)      # squares of very large or small components stay in range
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distinct(vectors: DataFrame, width: int) -> DataFrame:
    """``vec_id, key, v`` with a key that equal vectors share."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), width) + 0.0        # -0.0 equals 0.0
            keys = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x]
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), batch.column(1)], ["vec_id", "key", "v"])

    kind = vectors.schema["v"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, key binary, v {kind}")


def axes(reps: DataFrame, width: int) -> np.ndarray:
    """Principal axes as columns, leading first, of a bounded sample."""
    rows = reps.select("v").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toArrow()
    x = _units(_matrix(rows.column("v").combine_chunks(), width))
    x = x - x.mean(0)
    _, turn = np.linalg.eigh(x.T @ x)
    return turn[:, ::-1]


def _blocks(reps: DataFrame, turn: np.ndarray, epsilon: float) -> DataFrame:
    """A row for each interval of the sequence: ``block, number`` of vectors, ``low, high`` corners, and its data."""
    width, spark = len(turn), reps.sparkSession
    held = spark.sparkContext.broadcast(turn)
    leading = min(CELL_DIMENSIONS, width)

    def turned(batches):
        for batch in batches:
            x = _units(_matrix(batch.column(2), width))
            y = x @ held.value
            cells = np.floor(y[:, :leading] / epsilon).astype(np.int32)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(cells), pa.list_(pa.int32())),
                                   pa.array(y[:, 0]), pa.array([r.tobytes() for r in x], pa.binary()),
                                   pa.array([r.tobytes() for r in y], pa.binary())],
                                  ["rep", "copies", "cells", "first", "unit", "turned"])

    def cut(batches):
        from pyspark import TaskContext
        part, number, rows = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            rows.append(batch)
            while sum(r.num_rows for r in rows) >= BLOCK:
                table = pa.Table.from_batches(rows)
                yield _block(table.slice(0, BLOCK), part, number, width)
                rest = table.slice(BLOCK).to_batches()
                rows, number = rest, number + 1
        if sum(r.num_rows for r in rows):
            yield _block(pa.Table.from_batches(rows), part, number, width)

    sequence = reps.select("rep", "copies", "v").mapInArrow(
        turned, "rep long, copies long, cells array<int>, first double, unit binary, turned binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sequence.repartitionByRange(parts, "cells", "first", "rep").sortWithinPartitions("cells", "first", "rep")
    return ordered.select("rep", "copies", "unit", "turned").mapInArrow(
        cut, "part long, number long, low array<double>, high array<double>, reps binary, copies binary, units binary, "
             "codes binary")


def _block(table: pa.Table, part: int, number: int, width: int) -> pa.RecordBatch:
    y = b"".join(table.column("turned").to_pylist())
    box = np.frombuffer(y).reshape(-1, width)
    data = [table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("rep", "copies")]
    return pa.record_batch([pa.array([part]), pa.array([number]), pa.array([box.min(0)], pa.list_(pa.float64())),
                            pa.array([box.max(0)], pa.list_(pa.float64())), *(pa.array([d], pa.binary()) for d in data),
                            pa.array([b"".join(table.column("unit").to_pylist())], pa.binary()),
                            pa.array([np.floor(box[:, :CODED] / STEP).astype(np.int8).tobytes()], pa.binary())],
                           ["part", "number", "low", "high", "reps", "copies", "units", "codes"])


def _apart(a_low, a_high, b_low, b_high):
    """Square of the distance between two boxes."""
    gaps = F.zip_with(F.zip_with(a_low, b_high, lambda x, y: x - y), F.zip_with(b_low, a_high, lambda x, y: x - y),
                      lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)


def _near_pairs(boxes: DataFrame, most: int, epsilon: float) -> DataFrame:
    """``a <= b``: pairs of intervals whose boxes are within epsilon, by opening pairs of groups level by level."""
    levels = [boxes.select("block", "low", "high")]
    while most:
        most //= FAN
        levels.append(shared.stored(_groups(levels[-1]), "groups"))
    pairs = levels[-1].select(F.col("block").alias("a"), F.col("block").alias("b"))
    reach = (epsilon + _SLACK) ** 2
    for level in reversed(levels[:-1]):
        children = level.withColumn("parent", F.floor(F.col("block") / FAN).cast("long"))
        first = children.select(F.col("parent").alias("a"), F.struct("block", "low", "high").alias("x"))
        second = children.select(F.col("parent").alias("b"), F.struct("block", "low", "high").alias("y"))
        pairs = shared.stored(
            pairs.join(first, "a").join(second, "b").where("x.block <= y.block")
            .where(_apart(F.col("x.low"), F.col("x.high"), F.col("y.low"), F.col("y.high")) <= reach)
            .select(F.col("x.block").alias("a"), F.col("y.block").alias("b")), "near-pairs")
    return pairs


def _groups(level: DataFrame) -> DataFrame:
    """Boxes around each ``FAN`` boxes of consecutive numbers."""
    def around(key, table):
        low, high = (np.array(table.column(c).to_pylist()) for c in ("low", "high"))
        return pa.table({"block": [key[0].as_py()], "low": [low.min(0).tolist()], "high": [high.max(0).tolist()]})

    parent = F.floor(F.col("block") / FAN).cast("long")
    return level.select(parent.alias("parent"), "low", "high").groupBy("parent").applyInArrow(
        around, "block long, low array<double>, high array<double>")


def compare(x: np.ndarray, y: np.ndarray | None, x_copies: np.ndarray, y_copies: np.ndarray, cosine: float):
    """Weighted partners of each row, and the smallest row of its local component; ``y`` None: within ``x``."""
    m = len(x)
    if y is None:
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        counts, linked = near @ x_copies, near
    else:
        near = x @ y.T >= cosine
        counts = np.concatenate([near @ y_copies, near.T @ x_copies])
        size = m + len(y)
        linked = np.zeros((size, size), bool)
        linked[:m, m:] = near
        linked[m:, :m] = near.T
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1, initial=len(label)))
        least = least[least]
        if (least == label).all():
            return counts, label
        label = least


def possible(x: np.ndarray, y: np.ndarray, epsilon: float) -> np.ndarray:
    """Pairs whose coded coordinates do not put them further apart than epsilon."""
    x, y = x.astype(np.float32), y.astype(np.float32)
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)      # whole numbers, exact
    return square <= (epsilon / STEP + math.sqrt(x.shape[1]) + _SLACK) ** 2


def _links(blocks: DataFrame, pairs: DataFrame, width: int, epsilon: float, cosine: float) -> DataFrame:
    """``rep, root, links`` for every vector with a link in a pair of intervals."""
    coded = min(CODED, width)

    def sift(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                near = possible(*(np.frombuffer(row[c], np.int8).reshape(-1, coded) for c in ("x", "y")), epsilon)
                if row["a"] == row["b"]:
                    np.fill_diagonal(near, False)
                if near.any():
                    rows.append((row["a"], row["b"], near.any(1).tobytes(), near.any(0).tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.binary()] * 2, strict=True)],
                                  ["a", "b", "in_a", "in_b"])

    def pick(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                keep = np.frombuffer(row["in_a"], bool)
                rows.append([row["a"], row["b"], row["in_b"]] + [
                    np.frombuffer(row[c], np.uint8).reshape(len(keep), -1)[keep].tobytes()
                    for c in ("reps", "copies", "units")])
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.binary()] * 4, strict=True)],
                                  ["a", "b", "in_b", "a_reps", "a_copies", "a_units"])

    def meet(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keep = np.frombuffer(row["in_b"], bool)
                x, y = np.frombuffer(row["a_units"]).reshape(-1, width), np.frombuffer(row["units"]).reshape(-1, width)[keep]
                reps, weights = (np.frombuffer(row[c], np.int64) for c in ("a_reps", "a_copies"))
                if row["a"] == row["b"]:
                    counts, label = compare(x, None, weights, weights, cosine)
                else:
                    other, other_weights = (np.frombuffer(row[c], np.int64)[keep] for c in ("reps", "copies"))
                    counts, label = compare(x, y, weights, other_weights, cosine)
                    reps = np.concatenate([reps, other])
                some = counts > 0
                yield pa.record_batch([pa.array(reps[some]), pa.array(reps[label[some]]), pa.array(counts[some])],
                                      ["rep", "root", "links"])

    codes, data = blocks.select("block", "codes"), blocks.select("block", "reps", "copies", "units")
    hits = (pairs.join(codes.withColumnsRenamed({"block": "a", "codes": "x"}), "a")
            .join(codes.withColumnsRenamed({"block": "b", "codes": "y"}), "b")
            .mapInArrow(sift, "a long, b long, in_a binary, in_b binary"))
    picked = (hits.join(data.withColumnRenamed("block", "a"), "a").select("a", "b", "in_a", "in_b", "reps", "copies", "units")
              .mapInArrow(pick, "a long, b long, in_b binary, a_reps binary, a_copies binary, a_units binary"))
    return picked.join(data.withColumnRenamed("block", "b"), "b").mapInArrow(meet, "rep long, root long, links long")


def join(vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id",
         vector_column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Links are pairs of rows with a cosine of at least ``cosine`` (above 0); ``n_links`` counts other rows, equal
    vectors included, ``component_id`` is the smallest id that links lead to. Null and zero vectors and those with
    null or non-finite components link with nothing and are their own component; so are rows without id, with a null
    component. Vectors of unequal length are compared as if the shorter ended in zeros. Repeated rows link each
    other. An empty table gives an empty one; other columns are not read.
    """
    spark = vectors.sparkSession
    epsilon = math.sqrt(2 - 2 * cosine)
    good = usable(vectors, id_column, vector_column)
    width = good.agg(F.max(F.size("v"))).first()[0] or 1
    keyed = shared.stored(distinct(good, width), "vectors")
    reps = shared.stored(keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                  F.min_by("v", "vec_id").alias("v")), "distinct-vectors")
    cut = shared.stored(_blocks(reps, axes(reps, width), epsilon) if reps.take(1) else _no_blocks(spark), "intervals")
    stride = FAN ** math.ceil(math.log((cut.agg(F.max("number")).first()[0] or 0) + 1, FAN) or 0)
    blocks = cut.withColumn("block", F.col("part") * stride + F.col("number"))
    most = blocks.agg(F.max("block")).first()[0] or 0
    pairs = _near_pairs(blocks, most, epsilon)
    found = shared.stored(_links(blocks, pairs, width, epsilon, cosine), "vector-links")
    classes = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    told = (reps.select("key", "rep", "copies").join(classes, F.col("rep") == F.col("node"), "left")
            .join(links, "rep", "left")
            .select("key", F.coalesce("component", "rep").alias("component_id"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")))
    linked = keyed.select("vec_id", "key").join(told, "key").select("vec_id", "n_links", "component_id")
    v = F.col(vector_column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0)
    alone = (vectors.where(F.col(id_column).isNull() | v.isNull() | F.coalesce(bad, F.lit(True)))
             .select(F.col(id_column).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                     F.col(id_column).cast("long").alias("component_id")))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id",
                                            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _no_blocks(spark) -> DataFrame:
    return spark.createDataFrame([], "part long, number long, low array<double>, high array<double>, reps binary, "
                                     "copies binary, units binary, codes binary")
