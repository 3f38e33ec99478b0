"""Mixing sources to target weights by temperature, built from DataFrame functions only.

A source's weight is its share of all tokens raised to an exponent and normalised. The exponent is the largest
between 0 and 1 that meets the target entropy and the repetition limit, found by bisection. Each source then
gives its weight's part of the token budget: whole epochs, and of one more epoch a permutation of its blocks up
to the budget. A block is a set of documents by hash; blocks and the documents in them are permuted by hashes of
seed, source, epoch and block or document, so a document's part in the mix follows from its own row and one row
of its source, and texts are never shuffled or sorted.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm import shared

# Points between the ends that one pass over the sources tries, and passes: 32 ** 8 = 2 ** 40 parts.
POINTS, PASSES = 31, 8


@dataclass(frozen=True)
class Target:
    """entropy: part of the way from the sources' own entropy (0) to equal weights (1) that the mix reaches at
    least. repeats: how often a source may be repeated at most; the corpus' own shares always may.
    budget: tokens of the mix, by default as many as the corpus has. block: tokens of a block, on average."""

    entropy: float = 0.5
    repeats: float = 4.0
    budget: int | None = None
    block: int = 100_000
    seed: int = 7


def tokens(text: Column) -> Column:
    """Runs of characters other than blank, tab, line feed, carriage return and form feed."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f]+")), F.lit(0)).cast("long")


def _key(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _block(doc_id: Column, blocks: Column) -> Column:
    number = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return F.pmod(number, blocks)


def counted(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source",
            text_column: str = "text") -> DataFrame:
    return docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
                       tokens(F.col(text_column)).alias("n_tokens"))


def exponent(totals: DataFrame, target: Target) -> float:
    """Bisection over [0, 1]; every pass reads the totals once and tries ``POINTS`` places at a time.

    Both conditions hold at 1 or fail no more below a place where they fail: entropy falls and the largest
    repetition falls as the exponent grows. The repetition limit comes first: where it and the entropy exclude
    each other, the entropy gives way.
    """
    whole = totals.agg(F.sum("n_tokens")).first()[0]
    if not whole:
        return 1.0
    budget = target.budget or whole

    def at(points: list[float]) -> list[tuple[float, float, float]]:
        """Exponent, entropy and largest repetition, for each point."""
        share = F.col("n_tokens") / F.lit(float(whole))
        sums = []
        for x in points:
            w = F.pow("p", F.lit(x))
            sums += [F.sum(w), F.sum(w * F.col("l")), F.max(w / F.col("p"))]
        found = totals.where("n_tokens > 0").select(share.alias("p"), F.log(share).alias("l")).agg(*sums).first()
        return [(x, log(z) - x * s / z, r / z * budget / whole)
                for x, z, s, r in zip(points, found[::3], found[1::3], found[2::3], strict=True)]

    (_, most, _), (_, own, own_repeats) = at([0.0, 1.0])
    wanted = own + target.entropy * (most - own)
    limit = max(target.repeats, own_repeats)

    def bisect(holds, low: float, high: float) -> float:
        """The place in [low, high] up to which ``holds`` is false."""
        for _ in range(PASSES):
            points = [low + (high - low) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
            good = [x for x, *values in at(points) if holds(*values)]
            high = min(good, default=high)
            low = max([low, *[x for x in points if x < high]])
        return high

    (_, _, at_zero), = at([0.0])
    least = 0.0 if at_zero <= limit else bisect(lambda _, repeats: repeats <= limit, 0.0, 1.0)
    largest = 1.0 if own >= wanted else bisect(lambda entropy, _: entropy < wanted, 0.0, 1.0)
    return round(max(least, largest), 9)


def plan(light: DataFrame, target: Target) -> DataFrame:
    """A row for each source with tokens: ``source, n_blocks, weight, epochs, cut_block, cut_doc``.

    ``epochs`` are whole; of the next one, blocks with a key below ``cut_block`` belong to the mix, and of the
    block with that key the documents with a key up to ``cut_doc``. Both are null where nothing is left over.
    """
    totals = shared.stored(light.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens")), "mix-sources")
    whole = totals.agg(F.sum("n_tokens")).first()[0] or 0
    power = exponent(totals, target)
    weight = F.pow(F.col("n_tokens") / F.lit(float(whole or 1)), F.lit(power))
    norm = totals.where("n_tokens > 0").agg(F.sum(weight)).first()[0] or 1.0
    sources = (totals.where("n_tokens > 0").withColumn("weight", F.round(weight / F.lit(norm), 9))
               .withColumn("part", F.floor(F.col("weight") * F.lit(target.budget or whole)).cast("long"))
               .withColumn("n_blocks", F.ceil(F.col("n_tokens") / F.lit(target.block)).cast("long"))
               .withColumn("epochs", F.floor(F.col("part") / F.col("n_tokens")).cast("long"))
               .withColumn("rest", F.col("part") - F.col("epochs") * F.col("n_tokens")))
    seed = F.lit(target.seed)
    placed = (_with(light, sources.where("rest > 0"), "inner")
              .withColumn("block", _block(F.col("doc_id"), F.col("n_blocks"))))
    blocks = (placed.groupBy("source", "block", "epochs", "rest").agg(F.sum("n_tokens").alias("n_tokens"))
              .withColumn("block_key", _key(seed, F.col("source"), F.col("epochs"), F.col("block"))))
    order = Window.partitionBy("source").orderBy("block_key").rowsBetween(Window.unboundedPreceding, 0)
    cut = (blocks.withColumn("upto", F.sum("n_tokens").over(order))
           .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n_tokens") < F.col("rest")))
           .groupBy("source").agg(F.min(F.struct("block_key", "block", (F.col("rest") - F.col("upto") + F.col("n_tokens"))
                                                 .alias("left"))).alias("cut"))
           .select("source", "cut.block_key", F.col("cut.block").alias("cut_number"), "cut.left"))
    cut = shared.stored(cut, "mix-cuts")
    inside = Window.partitionBy("source").orderBy("doc_key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (_with(placed, cut, "inner").where(F.col("block") == F.col("cut_number"))
            .withColumn("doc_key", _key(seed, F.col("source"), F.col("epochs"), F.col("doc_id")))
            .withColumn("upto", F.sum("n_tokens").over(inside))
            .where(F.col("upto") >= F.col("left")).groupBy("source").agg(F.min("doc_key").alias("cut_doc")))
    found = _with(_with(sources, cut.select("source", F.col("block_key").alias("cut_block")), "left"), last, "left")
    return shared.stored(found.select("source", "n_blocks", "weight", "epochs", "cut_block", "cut_doc"), "mix-plan")


def _with(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on source, null equal to null. Catalyst broadcasts the source side only while it is small."""
    renamed = right.withColumnRenamed("source", "_source")
    both = left.join(renamed.select(*[c for c in renamed.columns if c == "_source" or c not in left.columns]),
                     F.col("source").eqNullSafe(F.col("_source")), how)
    return both.drop("_source")


def copies(rows: DataFrame, made: DataFrame, target: Target) -> DataFrame:
    """Rows with ``doc_id`` and ``source`` as often as the plan has them, with ``epoch, block, block_key``."""
    seed, source, epochs = F.lit(target.seed), F.col("source"), F.col("epochs")
    joined = _with(rows, made, "inner").withColumn("block", _block(F.col("doc_id"), F.col("n_blocks")))
    key = _key(seed, source, epochs, F.col("block"))
    partial = (key < F.col("cut_block")) | \
        ((key == F.col("cut_block")) & (_key(seed, source, epochs, F.col("doc_id")) <= F.col("cut_doc")))
    last = F.when(F.coalesce(partial, F.lit(False)), epochs).otherwise(epochs - 1)
    return (joined.withColumn("_last", last).where("_last >= 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
            .withColumn("block_key", _key(seed, source, F.col("epoch"), F.col("block"))))


def mix(docs: DataFrame, target: Target | None = None, id_column: str = "doc_id", source_column: str = "source",
        text_column: str = "text") -> DataFrame:
    """``doc_id, source, n_tokens, weight, epoch, block, block_key``: a row for each time a document is in the mix.

    Reading by ``epoch, block_key`` gives each source's block permutation. A null source is a source of its own,
    a null or empty text has no tokens, null ids are one id. Equal ids of one source stand or fall together, so
    repeated rows may pass the budget by their own size. A source without tokens is left out (its weight is 0); an
    empty table gives an empty mix; other columns are not read.
    """
    target = target or Target()
    light = shared.stored(counted(docs, id_column, source_column, text_column), "mix-tokens")
    return copies(light, plan(light, target), target).select(
        "doc_id", "source", "n_tokens", "weight", "epoch", "block", "block_key")


def mixed_documents(docs: DataFrame, target: Target | None = None) -> DataFrame:
    """The documents themselves, each as often as the mix has it, in their own columns."""
    target = target or Target()
    light = shared.stored(counted(docs), "mix-tokens")
    made = plan(light, target)
    keyed = docs.select(F.col("doc_id"), F.col("source"), F.struct(*docs.columns).alias("_row"))
    return copies(keyed, made, target).select("_row.*")
