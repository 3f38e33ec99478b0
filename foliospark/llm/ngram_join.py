"""N-gram Jaccard join: MinHash banding for candidates, whole n-gram sets for the answer.

Equal texts are one representative. Each representative has MinHash values of its word n-grams; bands of rows of
them are hashed, and representatives that share a band hash may be alike. The numbers of bands and rows are the
cheapest that reach the target recall at the threshold.

Representatives are laid out in blocks: the home of one is the largest band bucket it is in, and a home with more
than ``BLOCK`` members is cut by hash. Every bucket names the pairs of blocks it touches; for each pair of blocks
one task compares the full n-gram sets of all its members with an inverted index. So texts are sent once for each
pair of blocks and not for each pair of texts, a large group is spread over many tasks, links are counted in the
task, and what leaves it is a row for each member.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from foliospark.llm import shared
from foliospark.llm.components import components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
# Members of a block, and n-grams of their sets (16 MB), at most; one text may have more.
BLOCK, BLOCK_GRAMS = 256, 2 << 20
REMEMBERED = 400_000
_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def bands_and_rows(threshold: float, recall: float, most_hashes: int = 256) -> tuple[int, int]:
    """The most rows (fewest false candidates) whose bands reach the recall with at most ``most_hashes`` values."""
    best = None
    for rows in range(1, 33):
        share = threshold ** rows
        bands = 1 if share >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - share))
        if bands * rows <= most_hashes or best is None:
            best = (bands, rows)
    return best


class Shingler:
    """Texts to sets of 64-bit n-gram hashes; remembers word hashes for one Python worker."""

    def __init__(self, n: int = WORDS):
        self.n, self.known = n, {}

    def set(self, text: str | None) -> np.ndarray:
        """Sorted, distinct; a text with fewer words than ``n`` is one gram, one without words has none."""
        found = _WORD.findall(text.lower()) if text else []
        if not found:
            return np.zeros(0, np.uint64)
        known = self.known
        missing = {w for w in found if w not in known}
        if missing:
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
                missing = set(found)
            known.update((w, xxhash.xxh64_intdigest(w.encode())) for w in missing)
        hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        width = min(self.n, len(hashes))
        out = np.zeros(len(hashes) - width + 1, np.uint64)
        for k in range(width):
            out = _scramble(out * _MIX + hashes[k:k + len(out)])
        return np.unique(out)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> list[int]:
    """A hash for each band, empty for a text without grams."""
    if not len(grams):
        return []
    numbers = np.arange(1, bands * rows + 1, dtype=np.uint64)
    turns, factors = _scramble(numbers * _MIX), _scramble(numbers + _MIX) | np.uint64(1)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 256):
        least = np.minimum(least, ((grams[at:at + 256, None] ^ turns) * factors).min(0))
    out = np.full(bands, 17, np.uint64)
    for column in least.reshape(bands, rows).T:
        out = _scramble(out * _MIX + column)
    return out.view(np.int64).tolist()


def _text_key(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode())


def signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_key, bands, grams`` of every row; ``grams`` is the size of the set."""
    def run(batches):
        shingler = shared.worker_state(Shingler, n)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            keys = [_text_key(t) for t in texts]
            known: dict[bytes, tuple[list[int], int]] = {}
            for key, text in zip(keys, texts, strict=True):
                if key not in known:
                    found = shingler.set(text)
                    known[key] = band_hashes(found, bands, rows), len(found)
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), pa.array([known[k][0] for k in keys], pa.list_(pa.int64())),
                                   pa.array([known[k][1] for k in keys], pa.int64())],
                                  ["doc_id", "text_key", "bands", "grams"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text_key binary, bands array<long>, grams long")


def compare(grams: list[np.ndarray], weights: np.ndarray, split: int | None, threshold: float):
    """Links between sets: weighted number of partners and the smallest member of each one's local component.

    With ``split`` only pairs of a member before it and one from it on are compared. Positions stand for members.
    An inverted index adds up what pairs share; sizes that differ too much cannot reach the threshold.
    """
    m = len(grams)
    sizes = np.array([len(g) for g in grams], np.int64)
    values = np.concatenate(grams) if m else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(m), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    lengths = np.diff(np.append(starts, len(values)))
    common = np.zeros((m, m), np.int32)
    keep = lengths > 1
    starts, lengths = starts[keep], lengths[keep]
    for length in np.unique(lengths):
        group = owners[starts[lengths == length][:, None] + np.arange(length)]
        if length > 8:
            # Many sets hold these grams: a matrix of members by grams, multiplied in slices.
            for at in range(0, len(group), 8192):
                part = group[at:at + 8192]
                held = np.zeros((m, len(part)), np.float32)
                held[part.T, np.arange(len(part))] = 1
                common += (held @ held.T).astype(np.int32)
        else:
            for i in range(length):
                for j in range(length):
                    if i != j:
                        common += np.bincount(group[:, i] * m + group[:, j], minlength=m * m).reshape(m, m)
    union = sizes[:, None] + sizes[None, :] - common
    linked = (common > 0) & (common >= threshold * union - 1e-9)
    np.fill_diagonal(linked, False)
    if split is not None:
        linked[:split, :split] = False
        linked[split:, split:] = False
    counts = linked @ weights
    label = np.arange(m)
    while m:
        least = np.minimum(label, np.where(linked, label[None, :], m).min(1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    return counts, label


def join(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``doc_id, class_id, n_links, kept`` of every row.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams (lower case, letters and
    digits) reaches the threshold, or if their texts are equal; ``n_links`` counts linked rows other than the own.
    ``class_id`` is the smallest id that links lead to, ``kept`` holds for it. A null text is an empty text, and
    empty texts equal each other. Shorter texts are one gram. Repeated rows link each other and share an id, so
    both are kept; rows with one id but different texts share their links and class. Rows without id get a null class, no links, and are kept. An empty table gives an empty one.
    Ids are integers; others are refused before anything runs.
    """
    shared.integral(docs, "doc_id")
    spark = docs.sparkSession
    shared.bytes_per_batch(spark)
    bands, rows = bands_and_rows(threshold, recall)
    known = shared.stored(signed(docs, n, bands, rows), "signatures")
    texts = known.where("doc_id IS NOT NULL").groupBy("text_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"),
        F.first("grams").alias("grams"))
    texts = shared.stored(texts, "texts")
    placed = _blocks(texts)
    pairs = _block_pairs(placed)
    found = shared.stored(_verified(docs, texts, placed, pairs, n, threshold), "links")
    classes = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    told = (texts.join(classes, texts.rep == classes.node, "left").join(links, "rep", "left")
            .select("text_key", F.coalesce("component", "rep").alias("class_id"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")))
    with_id = known.where("doc_id IS NOT NULL").select("doc_id", "text_key").join(told, "text_key")
    without = known.where("doc_id IS NULL").select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"))
    return with_id.select("doc_id", "class_id", "n_links", (F.col("doc_id") == F.col("class_id")).alias("kept")) \
        .unionByName(without)


def _blocks(texts: DataFrame) -> DataFrame:
    """``rep, band, hash, block`` for every bucket with two members or more that a representative is in."""
    entries = texts.select("rep", "grams", F.posexplode("bands").alias("band", "hash"))
    sizes = entries.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = shared.stored(entries.join(sizes, ["band", "hash"]), "buckets")
    home = members.groupBy("rep").agg(F.max(F.struct("size", F.col("band"), F.col("hash"))).alias("home"), F.max("grams").alias("grams"))
    home = shared.stored(home.select("rep", "grams", "home.band", "home.hash"), "homes")
    living = home.groupBy("band", "hash").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("grams") / BLOCK_GRAMS)).alias("parts"))
    part = F.pmod(F.xxhash64(F.col("rep")), F.col("parts").cast("long"))
    blocks = home.join(living, ["band", "hash"]).select("rep", F.xxhash64("band", "hash", part).alias("block"))
    return members.join(blocks, "rep").select("rep", "band", "hash", "block")


def _block_pairs(placed: DataFrame) -> DataFrame:
    """``first <= second``: pairs of blocks that some bucket touches."""
    touched = placed.select("band", "hash", "block").distinct()
    other = touched.select("band", "hash", F.col("block").alias("second"))
    return (touched.withColumnRenamed("block", "first").join(other, ["band", "hash"])
            .where("first <= second").select("first", "second").distinct())


def _verified(docs: DataFrame, texts: DataFrame, placed: DataFrame, pairs: DataFrame, n: int,
              threshold: float) -> DataFrame:
    """``rep, root, links`` for each member of each pair of blocks that has a link there.

    A block is one row with the n-gram sets of its members; pairs of blocks are joined with these rows.
    """
    pairs = shared.stored(pairs, "block-pairs")
    wanted = shared.stored(placed.select("rep", "block").distinct().join(
        texts.select("rep", "copies", "text_key"), "rep"), "members")
    bits = docs.sparkSession.sparkContext.broadcast(shared.id_filter(wanted, "rep"))

    def gather(batches):
        shingler = shared.worker_state(Shingler, n)
        for batch in batches:
            part = batch.filter(pa.array(shared.in_filter(bits.value, batch.column(2).to_numpy(zero_copy_only=False))))
            texts = [t.as_py() or "" for t in part.column(1)]
            yield pa.record_batch([part.column(0), pa.array([_text_key(t) for t in texts], pa.binary()),
                                   pa.array([shingler.set(t).tobytes() for t in texts], pa.binary())],
                                  ["rep", "text_key", "grams"])

    def pack(key, table):
        table = table.sort_by([("rep", "ascending"), ("text_key", "ascending")])
        names = list(zip(table.column("rep").to_pylist(), table.column("text_key").to_pylist(), strict=True))
        table = table.filter(pa.array([k == 0 or x != names[k - 1] for k, x in enumerate(names)]))    # repeated rows
        sets = table.column("grams").to_pylist()
        row = [table.column("rep").to_numpy().tobytes(), table.column("copies").to_numpy().tobytes(),
               np.array([len(g) // 8 for g in sets], np.int64).tobytes(), b"".join(sets)]
        return pa.table([pa.array([key[0].as_py()], pa.int64()), *(pa.array([x], pa.binary()) for x in row)],
                        ["block", "reps", "copies", "sizes", "grams"])

    def verify(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sides = [_unpacked(row, ""), _unpacked(row, "b_")] if "b_reps" in row else [_unpacked(row, "")]
                reps, copies = (np.concatenate([side[k] for side in sides]) for k in (0, 1))
                counts, label = compare([g for side in sides for g in side[2]], copies,
                                        len(sides[0][0]) if len(sides) == 2 else None, threshold)
                some = counts > 0
                yield pa.record_batch([pa.array(reps[some]), pa.array(reps[label[some]]),
                                       pa.array(counts[some].astype(np.int64))], ["rep", "root", "links"])

    chosen = docs.where("doc_id IS NOT NULL").select("doc_id", "text", shared.filter_position(F.col("doc_id")).alias("at"))
    blocks = shared.stored(
        chosen.mapInArrow(gather, "rep long, text_key binary, grams binary").join(wanted, ["rep", "text_key"])
        .groupBy("block").applyInArrow(pack, "block long, reps binary, copies binary, sizes binary, grams binary"), "blocks")
    result = "rep long, root long, links long"
    within = blocks.join(pairs.where("first = second").select(F.col("first").alias("block")), "block").drop("block")
    others = blocks.withColumnsRenamed({c: f"b_{c}" for c in blocks.columns})
    between = (pairs.where("first < second").join(blocks, F.col("first") == F.col("block"))
               .join(others, F.col("second") == F.col("b_block")).drop("first", "second", "block", "b_block"))
    return within.mapInArrow(verify, result).unionByName(between.mapInArrow(verify, result))


def _unpacked(row: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    reps, copies, sizes = (np.frombuffer(row[prefix + c], np.int64) for c in ("reps", "copies", "sizes"))
    return reps, copies, np.split(np.frombuffer(row[prefix + "grams"], np.uint64), np.cumsum(sizes)[:-1])


def kept_documents(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One document of each class, in its own columns, whatever they are called.

    Of rows that share a kept id and text one stays; rows that share a kept id but not the text all stay.
    Only documents that a fixed-size filter of removed (or repeated) ids may hold are shuffled.
    """
    spark = docs.sparkSession
    judged = shared.stored(join(docs, n, threshold, recall), "classes")
    odd = judged.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).where("NOT kept OR rows > 1")
    odd = shared.stored(odd.select(F.col("doc_id").alias("id"), "kept"), "removed")
    bits = spark.sparkContext.broadcast(shared.id_filter(odd, "id"))
    rows = docs.select(F.struct("*").alias("row"), shared.filter_position(F.col("doc_id")).alias("at"))

    def part(inside: bool):
        def run(batches):
            for batch in batches:
                hit = shared.in_filter(bits.value, batch.column(1).to_numpy(zero_copy_only=False))
                yield batch.filter(pa.array(hit == inside)).select([0])
        return rows.mapInArrow(run, StructType([StructField("row", docs.schema)]))

    doubtful = part(True).withColumn("doc_id", F.col("row.doc_id")).join(odd, F.col("doc_id") == F.col("id"), "left")
    once = doubtful.where("id IS NULL")
    repeated = doubtful.where("kept").withColumn("text", F.coalesce("row.text", F.lit(""))).dropDuplicates(["id", "text"])
    return part(False).unionByName(once.select("row")).unionByName(repeated.select("row")).select("row.*")
