"""Context-triggered piecewise hashing: fingerprints of texts that stay alike when a part of the text changes.

A rolling hash over the last seven bytes ends a chunk where its low bits are all ones; each chunk gives one of
64 symbols. The block size (the mean chunk length, a power of two) is the smallest that gives at most
``MOST`` chunks, so whole texts are covered whatever their length. A fingerprint holds the signature at its
block size and at the double, and two fingerprints are compared where they share a block size.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.llm import shared

WINDOW = 7
SMALLEST = 2          # block size 4
MOST = 64
# Signatures without a run of this many equal symbols (or of the whole of the shorter one) are not alike.
RUN = 4
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_WEIGHTS = np.array([pow(0x01000193, k, 1 << 32) for k in range(1, WINDOW + 1)], np.uint32)


def _triggers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends of possible chunks at the smallest block size, and at how many low ones each hash ends."""
    values = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)
    rolling = np.zeros(len(values), np.uint32)
    for k in range(min(WINDOW, len(values))):
        rolling[k:] += values[:len(values) - k] * _WEIGHTS[k]
    rolling ^= rolling >> np.uint32(15)
    rolling *= np.uint32(0x2C1B3C6D)
    rolling ^= rolling >> np.uint32(13)
    low = np.uint32((1 << SMALLEST) - 1)
    ends = np.flatnonzero((rolling & low) == low)
    zeros = ~rolling[ends]
    ones = np.full(len(ends), 32, np.int64)
    some = zeros != 0
    ones[some] = np.log2((zeros[some] & (~zeros[some] + np.uint32(1))).astype(np.float64)).astype(np.int64)
    return ends + 1, ones


def _signature(data: bytes, ends: np.ndarray) -> str:
    cuts = [0, *ends.tolist()]
    if cuts[-1] != len(data):
        cuts.append(len(data))
    return "".join([_SYMBOLS[zlib.crc32(data[a:b]) & 63] for a, b in zip(cuts, cuts[1:], strict=False)])


def fingerprint(text: str | None) -> str:
    """``exponent:signature:signature at the double block size``; of a null or empty text ``2::``."""
    data = (text or "").encode()
    if not data:
        return f"{SMALLEST}::"
    ends, ones = _triggers(data)
    inner = ones[ends < len(data)]
    per_size = np.bincount(np.minimum(inner, 32), minlength=33)[::-1].cumsum()[::-1]    # chunks ended at 2^k
    size = SMALLEST
    while size < 32 and per_size[size] + 1 > MOST:
        size += 1
    if per_size[size] + 1 > MOST:          # one hash without end: every place or none is a boundary
        ends, ones = ends[:0], ones[:0]
    return f"{size}:{_signature(data, ends[ones >= size])}:{_signature(data, ends[ones >= size + 1])}"


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict[str, int] = {}
    for k, symbol in enumerate(a):
        places[symbol] = places.get(symbol, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for symbol in b:
        met = row & places.get(symbol, 0)
        row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(RUN, len(a), len(b))
    if not run:
        return 0.0
    runs = {a[k:k + run] for k in range(len(a) - run + 1)}
    if not any(b[k:k + run] in runs for k in range(len(b) - run + 1)):
        return 0.0
    return 2 * common(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """1 less the share of symbols to insert or delete, at the block sizes both have; 0 if they share none."""
    size_a, *sign_a = a.split(":")
    size_b, *sign_b = b.split(":")
    gap = int(size_a) - int(size_b)
    if gap == 0:
        if a == b:
            return 1.0
        return max(_alike(sign_a[0], sign_b[0]), _alike(sign_a[1], sign_b[1]) if len(sign_a[1]) >= RUN else 0.0)
    if gap == 1:
        return _alike(sign_a[0], sign_b[1])
    if gap == -1:
        return _alike(sign_a[1], sign_b[0])
    return 0.0


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row, in one narrow stage."""
    shared.bytes_per_batch(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                                   pa.array([fingerprint(t) for t in texts], pa.string())],
                                  ["doc_id", "n_chars", "fingerprint"])

    selected = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    return selected.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by as many first characters of the following text, or all."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _with_following(docs: DataFrame, intervals: int) -> DataFrame:
    """Rows laid out so that each text's follower in id order stands next to it.

    Ids are cut into intervals at quantiles; the first rows of each interval also go to the end of the one
    before it (of the first interval: to the last). Returns ``interval, after, doc_id, text``.
    """
    ids = docs.where(F.col("doc_id").isNotNull())
    cuts = sorted(set(ids.approxQuantile("doc_id", [k / intervals for k in range(1, intervals)],
                                         0.1 / intervals))) if intervals > 1 else []
    numbered = docs.withColumn("interval", _interval(cuts))
    # One row for each interval: at most as many as cuts, whatever the data.
    firsts = {row.interval: row.least for row in
              numbered.groupBy("interval").agg(F.min("doc_id").alias("least")).collect()}
    used = sorted(firsts, key=lambda i: (i >= 0, i))
    copies = [F.when((F.col("interval") == i) & F.col("doc_id").eqNullSafe(F.lit(firsts[i])),
                     F.struct(F.lit(used[k - 1]).alias("interval"), F.lit(True).alias("after")))
              for k, i in enumerate(used)]
    own = F.struct(F.col("interval"), F.lit(False).alias("after"))
    places = F.array(own, F.coalesce(*copies)) if copies else F.array(own)
    return (numbered.select(F.explode(F.filter(places, lambda p: p.isNotNull())).alias("place"), "doc_id", "text")
            .select("place.interval", "place.after", "doc_id", "text"))


def _interval(cuts: list[float]):
    """Number of cuts at or below the id; -1 for null ids, which come first."""
    return F.when(F.col("doc_id").isNull(), -1).otherwise(_bucket(cuts)).cast("int")


def _bucket(cuts: list[float]):
    """Binary search over the cuts as nested conditions."""
    def search(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") < cuts[middle], search(low, middle)).otherwise(search(middle + 1, high))
    return search(0, len(cuts))


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def against_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  intervals: int | None = None) -> DataFrame:
    """Every text's fingerprint, that of its edited text, and the likeness to it and to the next document.

    The next document is the next in ascending order of id, equal ids in order of text, null ids first; after
    the last comes the first, and a single row follows itself. A null text counts as empty. Repeated rows
    follow each other, an empty table gives an empty one, other columns are not read. Texts are shuffled once,
    to intervals of ids that are sorted, and stream through the task one after the other.
    """
    spark = docs.sparkSession
    shared.bytes_per_batch(spark)
    intervals = intervals or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    selected = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    laid = (_with_following(selected, intervals).repartition(intervals, "interval")
            .sortWithinPartitions("interval", "after", F.asc_nulls_first("doc_id"), "text"))
    kind = T._parse_datatype_string(f"doc_id {selected.schema['doc_id'].dataType.simpleString()}, {RESULT}")

    def run(batches):
        waiting, interval, out = None, None, []
        for batch in batches:
            columns = [batch.column(k) for k in range(4)]
            for k in range(batch.num_rows):
                now, after = columns[0][k].as_py(), columns[1][k].as_py()
                if now == interval and waiting is None:
                    continue                     # further copies of the next interval's first rows
                row = (columns[2][k].as_py(), columns[3][k].as_py())
                print_ = fingerprint(row[1])
                if now != interval:
                    waiting, interval = None, now
                if waiting is not None:
                    out.append(_compared(*waiting, row[1], print_))
                waiting = None if after else (*row, print_)
                if len(out) >= 256:
                    yield _as_batch(out, kind)
                    out = []
        if out:
            yield _as_batch(out, kind)

    return laid.mapInArrow(run, kind)


def _compared(doc_id, text: str, own: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following)
    changed_print = fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, changed_print,
            likeness(own, changed_print), likeness(own, next_print))


def _as_batch(rows: list[tuple], kind: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(kind)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                           schema=schema)
