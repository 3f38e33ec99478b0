"""Spelling variants: words one edit apart, by composing the vocabulary's acceptor with a one-edit transducer and itself.

The composed machine starts in (root, 0, root). A state (p, 0, p) whose words are few is a cell: its words' acceptor is
built and composed in one task (``acceptors``). A state with more words is unfolded: its match arcs lead to the states
behind p's next symbol, its edit arcs to states behind the edit, where only equal remainders are accepted; these meet
by a grouping on (p, remainder), at most one word for each symbol of the alphabet and one more. So a cell is bounded
whatever share of the words has one beginning, and every pair is found in exactly one place, that of its first
difference. Small cells are packed to tasks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm import acceptors, shared
from foliospark.operators.tables import union_by

# Words in a cell, at most, and their code points; one word may have more.
CELL, CELL_POINTS = 20_000, 4 << 20
SHORTEST, TIMES, DAMAGE = 7, 10, 31
# Distinct words counted by a task before they are handed on.
REMEMBERED = 200_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 2) -> DataFrame:
    """``word, n`` of the words of at least ``SHORTEST`` code points that occur ``least`` times or more.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, one byte each in Latin-1; A-Z are lower-cased. Where
    ``DAMAGE`` divides the crc32 h of ``<doc_id>:<run>`` (UTF-8; a null id is empty), code point h modulo the length goes.
    """
    spark = docs.sparkSession
    shared.bytes_per_batch(spark)
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)   # shorter runs cannot become words

    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                start, text = zlib.crc32(key.as_py().encode() + b":"), text.as_py()
                for word, n in Counter(runs.findall((text or "").encode("latin-1", "replace").translate(_LOWER))).items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if h % DAMAGE == 0:
                        word = word[:h % len(word)] + word[h % len(word) + 1:]
                        if len(word) < SHORTEST:
                            continue
                    found[word] += n
                if len(found) > REMEMBERED:
                    yield from _counts(found)
                    found = Counter()
        yield from _counts(found)

    selected = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.col(text_column))
    return (selected.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least))


def _counts(found: Counter):
    words = list(found)
    for at in range(0, len(words), 50_000):
        part = words[at:at + 50_000]
        yield pa.record_batch([pa.array([w.decode("latin-1") for w in part], pa.string()),
                               pa.array([found[w] for w in part], pa.int64())], ["word", "n"])


def _common(a: Column, b: Column) -> Column:
    """Length of the longest common prefix, by halving steps."""
    steps = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))

    def longer(length: Column, step: Column) -> Column:
        upto = length + step
        fits = (F.length(a) >= upto) & (F.length(b) >= upto) & (F.substring(a, F.lit(1), upto) == F.substring(b, F.lit(1), upto))
        return F.when(fits, upto).otherwise(length)

    return F.aggregate(steps, F.lit(0), longer)


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """``word, n, n_near, near_n, near``: of each row of ``word, n`` (distinct words), the number of words one edit apart
    and the most frequent of them, of equals the smallest in code-point order.

    Null and empty words must not be there; a word without near words has 0 and nulls.
    """
    words = words.select("word", "n")
    found = [words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                          F.lit(None).cast("struct<m:long,near:string>").alias("best"))]
    active, leaves = words.withColumn("depth", F.lit(0)), []
    while True:
        prefix = F.substring("word", F.lit(1), F.col("depth"))
        groups = shared.stored(
            active.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("size"), F.sum(F.length("word")).alias("points"),
                                                       F.min("word").alias("low"), F.max("word").alias("high"))
            .where("size > 1").withColumn("large", F.expr(f"size > {cell} OR points > {CELL_POINTS}"))
            .select("prefix", "large", F.when(F.col("large"), _common(F.col("low"), F.col("high"))).alias("branch")), "spelling-groups")
        placed = shared.stored(active.withColumn("prefix", prefix).join(groups, "prefix"), "spelling-words")
        leaves.append(placed.where("NOT large").select("word", "n", "depth", "prefix"))
        if groups.where("large").isEmpty():
            break
        large = placed.where("large")
        found.append(_behind_edit(large))
        active = large.where(F.length("word") > F.col("branch")).select("word", "n", (F.col("branch") + 1).alias("depth"))
    found.append(_composed(leaves, cell))
    best = F.min("best").alias("best")
    return (union_by("word", *found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
            .select("word", "n", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.near").alias("near")))


def _behind_edit(large: DataFrame) -> DataFrame:
    """Pairs whose first difference is at ``branch``: equal remainders behind a replaced or an inserted symbol.

    A word comes with its symbol there read by the edit arc, and with none. Of those with one remainder all of the first
    kind are replacements of each other; the second kind has one word, which is near the others unless their symbol is
    also the first of the remainder (that difference lies further behind).
    """
    at = F.col("branch")
    symbol, rest = F.substring("word", at + 1, F.lit(1)), F.substring("word", at + 2, F.length("word"))
    start = F.substring("word", F.lit(1), at)
    read = large.where(F.length("word") > at).select(start.alias("start"), rest.alias("rest"), symbol.alias("symbol"), "word", "n")
    stay = large.select(start.alias("start"), F.substring("word", at + 1, F.length("word")).alias("rest"), F.lit("").alias("symbol"), "word", "n")
    groups = (read.unionByName(stay).repartition("start", "rest").groupBy("start", "rest")
              .agg(F.collect_list(F.struct("symbol", "word", "n")).alias("members")).where(F.size("members") > 1))
    one = groups.select("members", F.substring("rest", 1, 1).alias("next"), F.explode("members").alias("own"))

    def near(other: Column) -> Column:
        same_kind = (F.col("own.symbol") != "") & (other["symbol"] != "")
        differs = F.concat(F.col("own.symbol"), other["symbol"]) != F.col("next")       # the one that was read
        return (other["word"] != F.col("own.word")) & (same_kind | differs)

    others = one.select("own", F.filter("members", near).alias("others")).where(F.size("others") > 0)
    return others.select(F.col("own.word").alias("word"), F.col("own.n").alias("n"), F.size("others").cast("long").alias("n_near"),
                         F.array_min(F.transform("others", lambda m: F.struct((-m["n"]).alias("m"), m["word"].alias("near")))).alias("best"))


def _composed(leaves: list[DataFrame], cell: int) -> DataFrame:
    """Near words inside the cells; cells are packed by a hash of their prefix, about ``cell`` words together."""
    cells = leaves[0]
    for more in leaves[1:]:
        cells = cells.unionByName(more)
    packs = max(1, -(-cells.count() // cell))
    packed = cells.select(F.pmod(F.xxhash64("prefix", "depth"), F.lit(packs)).alias("pack"), "depth", "n", "word")

    def run(table: pa.Table) -> pa.Table:
        words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        order = sorted(range(len(words)), key=words.__getitem__)
        words = [words[k] for k in order]
        n, depth = (table.column(c).to_numpy()[order] for c in ("n", "depth"))
        left, right = acceptors.near_pairs(acceptors.Acceptor(words), depth)
        one, two = np.concatenate((left, right)), np.concatenate((right, left))
        by = np.lexsort((two, -n[two], one))             # places follow the code-point order
        first = by[np.flatnonzero(np.diff(one[by], prepend=-1))] if len(by) else by
        at, best = one[first], two[first]
        texts = table.column("word").combine_chunks()
        order = np.array(order, np.int64)
        counts = np.bincount(one, minlength=len(words))[at]
        return pa.table({"word": texts.take(pa.array(order[at])), "n": pa.array(n[at]), "n_near": pa.array(counts.astype(np.int64)),
                         "m": pa.array(-n[best]), "near": texts.take(pa.array(order[best]))})

    return (packed.groupBy("pack").applyInArrow(run, "word string, n long, n_near long, m long, near string")
            .select("word", "n", "n_near", F.struct("m", "near").alias("best")))


def group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``vocabulary``.

    ``form`` is the most frequent near word where it occurs ``TIMES`` as often or more, ``root`` the end of the chain of
    forms; a chain has as many steps as the largest count has digits, at most, so the pointers are doubled a few times.
    Null and empty texts have no words, null ids count as empty ones, repeated rows count each, an empty table gives an
    empty one; other columns are not read. A very long run is one word and takes steps in proportion to its length.
    """
    near = shared.stored(near_words(shared.stored(vocabulary(docs, id_column, text_column), "spelling-vocabulary")), "spelling-near")
    accepted = F.col("near_n") >= TIMES * F.col("n")
    forms = near.select("word", F.when(accepted, F.col("near")).alias("form"), "n", "n_near", F.when(accepted, F.col("near_n")).alias("form_n"))
    roots = shared.stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = shared.stored(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                        F.col("further").isNotNull().alias("moved")), "spelling-roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return (forms.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
