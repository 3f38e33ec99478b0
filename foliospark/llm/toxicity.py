"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two models, one for toxic and one for ordinary texts, are interpolated Kneser-Ney models of order six: raw counts
at the top, counts of distinct left neighbours below. From order ``SHARED`` down both use the same counts, taken
over both classes, so expressions that neither class has seen give no evidence. A word's evidence is the
difference of its log-likelihoods; a text is judged by length-normalised evidence: per character over the whole
text and over its most toxic window of words, by its most toxic word and the mean of its three most toxic ones, and
by all evidence beyond ``CLEAR`` over the root of the number of words. A logistic curve turns these into a score. It is
fitted on rows of one learning fold as models see them that are counted without that fold; the models that score are
counted with all learning folds. Both are built side by side, in the same passes.

The models are tables: every order's grams and contexts are counted, weighted and looked up by joins, and nothing of
them is collected. Documents are packed in pieces of rows with the distinct words of each; a piece asks for each of its
distinct grams once, whatever its words are, and gets their values back. ``build`` and ``Model`` are the same models in
memory, for small tables.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm import shared

ORDER, SHARED = 6, 2
WINDOW = 5
CLEAR = 3.0
FEATURES = ("whole", "window", "word", "three_words", "clear")
# Bytes of text in a piece, about; a longer text ends one. Its rows travel in parts of about so many words, and Arrow
# batches have about so many bytes, so that no row is large.
PIECE, PART, BATCH = 16 << 20, 1 << 20, 4 << 20
# Labelled rows the logistic curve is fitted on, at most; they are the first in order of a hash of the id.
CURVE_ROWS = 5_000
REMEMBERED = 100_000
FOLDS, HELD_OUT, CURVE = 5, 0, 1

_WORDS = re.compile(r"[^\W_]+")
_START, _END = "\x02", "\x03"


def words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text modulo ``FOLDS``; null ids are held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS, F.lit(HELD_OUT))


def grams(word: str) -> list[str]:
    padded = _START * (ORDER - 1) + word + _END
    return [padded[k:k + ORDER] for k in range(len(word) + 1)]


class Grams:
    """The grams of many words as numbers in the base of their alphabet, some words at a time."""

    def __init__(self, found: list[str]):
        self.found = found
        self.lengths = np.fromiter(map(len, found), np.int64, len(found))
        alphabet = {_START, _END}.union(*(set("".join(found[a:b])) for a, b in self._chunks()))
        self.alphabet = np.array(sorted(map(ord, alphabet)), np.uint32)
        self.base = len(self.alphabet)
        if self.base ** ORDER < 1 << 63:
            self.halves = None
        else:                                            # three characters are one digit then
            self.halves = np.unique(np.concatenate([np.unique(self._threes(self._code(a, b)[0])) for a, b in self._chunks()]))
        parts = [np.unique(self.numbers(a, b)[0]) for a, b in self._chunks()]
        self.distinct = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

    def _chunks(self, size: int = 32_768) -> list[tuple[int, int]]:
        """Ranges of words, cut after so many or after that many characters."""
        ends = np.cumsum(self.lengths + 8)
        cuts = np.flatnonzero(np.diff(ends // (16 * size))) + 1
        return [(a, b) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(self.found)], strict=True) if a < b]

    def _code(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Digits of the padded words, and where their grams begin."""
        pad, sizes = _START * (ORDER - 1), self.lengths[a:b] + 1
        text = pad + (_END + pad).join(self.found[a:b]) + _END
        code = np.searchsorted(self.alphabet, np.frombuffer(text.encode("utf-32-le"), np.uint32))
        return code, np.arange(sizes.sum()) + np.repeat(np.arange(b - a) * (ORDER - 1), sizes)

    def _threes(self, code: np.ndarray) -> np.ndarray:
        return (code[:-2] * self.base + code[1:-1]) * self.base + code[2:]

    def numbers(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """A number for each gram of these words in order, and each word's first place."""
        code, places = self._code(a, b)
        half, base = self._threes(code), self.base ** 3
        if self.halves is not None:
            half, base = np.searchsorted(self.halves, half), len(self.halves)
        sizes = self.lengths[a:b] + 1
        return half[places] * base + half[places + 3], np.cumsum(sizes) - sizes

    def spelled(self) -> list[str]:
        """The distinct grams."""
        base = self.base ** 3 if self.halves is None else len(self.halves)
        halves = [self.distinct // base, self.distinct % base]
        if self.halves is not None:
            halves = [self.halves[h] for h in halves]
        digits = np.stack([h // self.base ** k % self.base for h in halves for k in (2, 1, 0)], axis=1)
        text = self.alphabet[digits].astype(np.uint32).tobytes().decode("utf-32-le")
        return [text[k:k + ORDER] for k in range(0, len(text), ORDER)]

    def evidence(self, values: np.ndarray) -> np.ndarray:
        """Of each word, the sum of its grams' values."""
        out = np.zeros(len(self.found))
        for a, b in self._chunks():
            numbers, begins = self.numbers(a, b)
            out[a:b] = np.add.reduceat(values[np.searchsorted(self.distinct, numbers)], begins)
        return out

    def counts(self, weights: np.ndarray) -> np.ndarray:
        """Of each distinct gram, the sum of the weights of the words at its places; a column for each column of weights."""
        out = np.zeros((len(self.distinct), weights.shape[1]), np.int64)
        for a, b in self._chunks():
            place = np.searchsorted(self.distinct, self.numbers(a, b)[0])
            word = np.repeat(np.arange(a, b), self.lengths[a:b] + 1)
            for k in range(weights.shape[1]):
                out[:, k] += np.bincount(place, weights[word, k], len(out)).astype(np.int64)
        return out


@dataclass
class Curve:
    """Logistic curve over scaled features."""

    curve: np.ndarray = field(default_factory=lambda: np.array([0.0] * len(FEATURES) + [-3.0]))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(features / self.scale @ self.curve[:-1] + self.curve[-1], -40, 40)
        return 1 / (1 + np.exp(-z))


@dataclass
class Model:
    """Log-ratio of a gram both models know, and of the weights a context leaves to the next lower order."""

    ratio: dict[str, float]
    backoff: dict[str, float]

    def word(self, word: str) -> float:
        """log P(word | toxic) - log P(word | ordinary)."""
        total, ratio, backoff = 0.0, self.ratio, self.backoff
        for gram in grams(word):
            while len(gram) > SHARED:
                found = ratio.get(gram)
                if found is not None:
                    total += found
                    break
                total += backoff.get(gram[:-1], 0.0)
                gram = gram[1:]
        return total


def build(table: dict[str, tuple[int, int]]) -> Model:
    """Both models from counts of the highest order, toxic and ordinary."""
    counts = {ORDER: table}
    for n in range(ORDER, 1, -1):
        lower: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
        for gram, found in counts[n].items():
            c = lower[gram[1:]]
            c[0] += found[0] > 0
            c[1] += found[1] > 0
            c[2] += 1
        counts[n - 1] = lower
    lowest = _probabilities(counts[SHARED], 2, _probabilities(counts[1], 2, None)[0])[0]
    below = [lowest, lowest]
    ratio, backoff = {}, {}
    for n in range(SHARED + 1, ORDER + 1):
        (toxic, toxic_rest), (ordinary, ordinary_rest) = (_probabilities(counts[n], c, below[c]) for c in (0, 1))
        for gram in counts[n]:
            ratio[gram] = log(toxic[gram]) - log(ordinary[gram])
        for context in toxic_rest.keys() | ordinary_rest.keys():
            backoff[context] = log(toxic_rest.get(context, 1.0)) - log(ordinary_rest.get(context, 1.0))
        below = [toxic, ordinary]
    return Model(ratio, backoff)


def _probabilities(counts: dict, c: int, below: dict[str, float] | None) -> tuple[dict[str, float], dict[str, float]]:
    """Probability of each gram, and what each context that was seen leaves to the order below."""
    ones = sum(x[c] == 1 for x in counts.values())
    twos = sum(x[c] == 2 for x in counts.values())
    discount = ones / (ones + 2 * twos) if ones and twos else 0.75
    total, kinds = Counter(), Counter()
    for gram, x in counts.items():
        if x[c]:
            total[gram[:-1]] += x[c]
            kinds[gram[:-1]] += 1
    rest = {h: discount * kinds[h] / total[h] for h in total}
    uniform = 1 / (len(counts) + 1)
    out = {}
    for gram, x in counts.items():
        h = gram[:-1]
        lower = uniform if below is None else below[gram[1:]]
        out[gram] = (max(x[c] - discount, 0) / total[h] + rest[h] * lower) if h in total else lower
    return out, rest


@dataclass
class Tables:
    """The values of ``Model`` by order: ``gram, ratio`` of its grams and ``context, backoff`` of their contexts.

    Both are empty where a class has no rows; no word is evidence then.
    """

    ratio: dict[int, DataFrame]
    backoff: dict[int, DataFrame]
    curve: Curve = field(default_factory=Curve)


def build_tables(table: DataFrame, variants: int = 1) -> list[Tables]:
    """``build`` for a table of any size: ``gram`` and for each variant k ``toxic{k}, ordinary{k}``, models side by side.

    A gram that a variant has not counted is not in its model.
    """
    each = range(variants)
    counts = {ORDER: table.select("gram", *(c for k in each for c in (
        F.col(f"toxic{k}").alias(f"c0_{k}"), F.col(f"ordinary{k}").alias(f"c1_{k}"),
        F.when(F.col(f"toxic{k}") + F.col(f"ordinary{k}") > 0, 1).otherwise(0).alias(f"c2_{k}"))))}
    for n in range(ORDER, 1, -1):
        counts[n - 1] = shared.stored(
            counts[n].groupBy(F.substring("gram", 2, n - 1).alias("gram"))
            .agg(*(F.count_if(F.col(f"c{c}_{k}") > 0).alias(f"c{c}_{k}") for k in each for c in range(3))), f"toxic-counts-{n - 1}")
    below, out = None, [Tables({}, {}) for _ in each]
    for n in range(1, ORDER + 1):
        probabilities, contexts = _probability_tables(counts[n], n, (2, 2) if n <= SHARED else (0, 1), below, variants)
        below = shared.stored(probabilities, f"toxic-probabilities-{n}")
        if n > SHARED:
            for k in each:
                rests = [F.coalesce(f"rest{c}_{k}", F.lit(1.0)) for c in (0, 1)]
                out[k].ratio[n] = below.where(f"seen_{k}").select("gram", (F.log(f"p0_{k}") - F.log(f"p1_{k}")).alias("ratio"))
                out[k].backoff[n] = (contexts.where(f"total0_{k} + total1_{k} > 0")
                                     .select("context", (F.log(rests[0]) - F.log(rests[1])).alias("backoff")))
    shared.remove(*(counts[n] for n in range(1, ORDER)))
    return out


def _probability_tables(counts: DataFrame, n: int, classes: tuple[int, int], below: DataFrame | None,
                        variants: int) -> tuple[DataFrame, DataFrame]:
    """``_probabilities`` of both classes of each variant: ``gram, seen, p0, p1``, and ``context, total0, total1, rest0, rest1``.

    A context or suffix has no more grams than there are characters, whatever the data.
    """
    both = [(c, of, k) for k in range(variants) for c, of in enumerate(classes)]
    stats = counts.agg(*(F.count_if(F.col(f"c2_{k}") > 0).alias(f"kinds_{k}") for k in range(variants)),
                       *(F.count_if(F.col(f"c{of}_{k}") == x).alias(f"c{of}_{k}_{x}") for _, of, k in {(0, y, z) for _, y, z in both} for x in (1, 2))).first()

    def discount(of: int, k: int) -> float:
        ones, twos = stats[f"c{of}_{k}_1"], stats[f"c{of}_{k}_2"]
        return ones / (ones + 2 * twos) if ones and twos else 0.75

    grams_of = counts.withColumn("context", F.substring("gram", 1, n - 1))
    totals = grams_of.groupBy("context").agg(
        *(F.sum(f"c{of}_{k}").alias(f"total{c}_{k}") for c, of, k in both),
        *(F.count_if(F.col(f"c{of}_{k}") > 0).alias(f"kinds{c}_{k}") for c, of, k in both))
    contexts = shared.stored(totals.select("context", *(f"total{c}_{k}" for c, _, k in both), *(
        F.when(F.col(f"total{c}_{k}") > 0, F.lit(discount(of, k)) * F.col(f"kinds{c}_{k}") / F.col(f"total{c}_{k}")).alias(f"rest{c}_{k}")
        for c, of, k in both)), f"toxic-contexts-{n}")
    if below is None:                          # one context, as many grams as characters
        joined = grams_of.join(F.broadcast(contexts), "context").select(
            "*", *(F.lit(1 / (stats[f"kinds_{k}"] + 1)).alias(f"lower{c}_{k}") for c, _, k in both))
    else:
        lower = below.select(F.col("gram").alias("suffix"), *(F.col(f"p{c}_{k}").alias(f"lower{c}_{k}") for c, _, k in both))
        joined = (grams_of.withColumn("suffix", F.substring("gram", 2, n - 1))
                  .join(contexts, "context").join(lower, "suffix"))

    def probability_of(c: int, of: int, k: int) -> Column:
        count, total, rest, low = (F.col(f"{x}_{k}") for x in (f"c{of}", f"total{c}", f"rest{c}", f"lower{c}"))
        return F.when(total > 0, F.greatest(count - F.lit(discount(of, k)), F.lit(0.0)) / total + rest * low).otherwise(low)

    return joined.select("gram", *((F.col(f"c2_{k}") > 0).alias(f"seen_{k}") for k in range(variants)),
                         *(probability_of(c, of, k).alias(f"p{c}_{k}") for c, of, k in both)), contexts


def gram_values(asked: DataFrame, model: Tables) -> DataFrame:
    """``gram, value``: what each distinct gram of the highest order adds to a word's evidence.

    Each order is stored before the next one asks for it: one plan for all orders holds so many joins and shuffles that
    its many adaptive rewrites fill the driver's memory, whatever the data.
    """
    wanted = shared.stored(asked.select("gram").distinct(), "toxic-wanted")
    values = None
    for n in range(SHARED + 1, ORDER + 1):
        known = wanted if n == ORDER else wanted.select(F.substring("gram", ORDER - n + 1, n).alias("gram")).distinct()
        known = known.withColumns({"context": F.substring("gram", 1, n - 1), "suffix": F.substring("gram", 2, n - 1)})
        known = known.join(model.ratio[n], "gram", "left").join(model.backoff[n], "context", "left")
        lower, below = F.lit(0.0), values
        if below is not None:
            known = known.join(below.select(F.col("gram").alias("suffix"), F.col("value").alias("lower")), "suffix")
            lower = F.col("lower")
        values = shared.stored(known.select("gram", F.coalesce("ratio", F.coalesce("backoff", F.lit(0.0)) + lower).alias("value")),
                               f"toxic-values-{n}")
        if below is not None:
            shared.remove(below)
    shared.remove(wanted)
    return values


def features(evidence: np.ndarray, sizes: np.ndarray) -> tuple[float, ...]:
    """The values of ``FEATURES`` from the evidence of a text's words in order, and their lengths and one."""
    if not len(evidence):
        return (0.0,) * len(FEATURES)
    sums, lengths = (np.concatenate(([0.0], np.cumsum(x))) for x in (evidence, sizes))
    width = min(WINDOW, len(evidence))
    best = ((sums[width:] - sums[:-width]) / (lengths[width:] - lengths[:-width])).max()
    most = -np.partition(-evidence, min(3, len(evidence)) - 1)[:3]
    clear = np.maximum(evidence - CLEAR, 0).sum() / np.sqrt(len(evidence))
    return float(sums[-1] / lengths[-1]), float(best), float(evidence.max()), float(most.mean()), float(clear)


def labelled(docs: DataFrame, labels: DataFrame, folds: list[int]) -> DataFrame:
    """``text, toxic, curve`` of the labelled documents of some folds; ``curve``: whether of the fold ``CURVE``.

    Only documents that a fixed-size filter of labelled ids lets through are shuffled to meet their labels. Few labels are
    not broadcast either: the filter and the count of words would be one stage then, with two Python workers a task, and
    an executor keeps its workers, in turn, with what each has taken.
    """
    wanted = _wanted(labels, folds)
    bits = docs.sparkSession.sparkContext.broadcast(shared.id_filter(wanted, "doc_id"))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.in_filter(bits.value, batch.column(2).to_numpy()))).select([0, 1])

    selected = docs.select("doc_id", "text", shared.filter_position(F.col("doc_id")).alias("at"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    return (selected.mapInArrow(run, f"doc_id {kind}, text string").join(wanted.hint("merge"), "doc_id")
            .select("text", "toxic", (fold(F.col("doc_id")) == CURVE).alias("curve")))


def _wanted(labels: DataFrame, folds: list[int]) -> DataFrame:
    """``doc_id, toxic`` (0 or 1) of some folds. A document with several labels is toxic if one says so; null labels do not count."""
    return (labels.select("doc_id", "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .where(fold(F.col("doc_id")).isin(folds)).groupBy("doc_id").agg((F.max("toxic") != 0).cast("int").alias("toxic")))


def counted(rows: DataFrame) -> DataFrame:
    """``gram, toxic0, ordinary0, toxic1, ordinary1`` over all rows of ``text, toxic, curve``: 0 without rows of the curve, 1 all.

    Words are counted in each task, then their grams, before the shuffle.
    """
    names = ["toxic0", "ordinary0", "toxic1", "ordinary1"]

    def run(batches):
        shared.forget()
        found = [Counter() for _ in range(4)]           # by toxic and curve
        for batch in batches:
            for text, toxic, curve in zip(*batch.columns, strict=True):
                found[2 * (not toxic.as_py()) + curve.as_py()].update(words(text.as_py()))
            if sum(map(len, found)) > REMEMBERED:
                yield from tables(found)
                found = [Counter() for _ in range(4)]
        yield from tables(found)

    def tables(found):
        kinds = list(set().union(*found))
        made = Grams(kinds)
        by_kind = [np.fromiter(map(c.__getitem__, kinds), np.int64, len(kinds)) for c in found]
        sums = made.counts(np.stack([by_kind[0], by_kind[2], by_kind[0] + by_kind[1], by_kind[2] + by_kind[3]], axis=1))
        keys = made.spelled()
        for at in range(0, len(keys), 50_000):
            part = sums[at:at + 50_000]
            yield pa.record_batch([pa.array(keys[at:at + 50_000], pa.string()), *(pa.array(np.ascontiguousarray(c)) for c in part.T)], ["gram", *names])

    return (rows.select("text", "toxic", "curve").mapInArrow(run, "gram string, " + ", ".join(f"{c} long" for c in names))
            .groupBy("gram").agg(*(F.sum(c).alias(c) for c in names)))


def fit(docs: DataFrame, labels: DataFrame) -> Tables:
    """Models of all labelled rows of the learning folds, and their curve.

    The curve is fitted on at most ``CURVE_ROWS`` rows of one fold, as models without that fold see them; where that
    fold or the rest lacks a class, on rows of all learning folds.
    """
    shared.bytes_per_batch(docs.sparkSession, BATCH)
    learning = [k for k in range(FOLDS) if k != HELD_OUT]
    table = shared.stored(counted(labelled(docs, labels, learning)), "toxic-grams")
    sums = table.agg(*(F.sum(c) for c in table.columns[1:])).first()
    if not sums[2] or not sums[3]:
        return Tables({}, {})
    others, model = build_tables(table, 2)
    for folds, seen_by in ([([CURVE], others)] if sums[0] and sums[1] else []) + [(learning, model)]:
        sample = _wanted(labels, folds).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CURVE_ROWS)
        rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")       # at most CURVE_ROWS ids
        found = featured(rows, seen_by, ["doc_id", "toxic"]).toPandas().sort_values("doc_id")
        if found["toxic"].nunique() > 1:
            fit_curve(model.curve, found[list(FEATURES)].to_numpy(float), found["toxic"].to_numpy(float))
            break
    return model


def fit_curve(model: Curve, features: np.ndarray, toxic: np.ndarray, penalty: float = 1e-4) -> None:
    """Logistic regression by Newton steps on scaled features."""
    model.scale = np.maximum(features.std(0), 1e-6)
    x = np.column_stack([features / model.scale, np.ones(len(features))])
    ridge = np.array([penalty] * (x.shape[1] - 1) + [1e-6])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - toxic * z).mean() + (ridge * w * w).sum() / 2)

    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        slope = x.T @ (p - toxic) / len(x) + ridge * weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag(ridge + 1e-9), slope)
        size = 1.0
        while size > 1e-4 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    model.curve = weights


class _Numbers(dict):
    """A number for each new key, in order."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _pieces(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``piece, words, rows``: the distinct words of each piece (in its first part) and its rows with the numbers of their words."""
    from pyspark import TaskContext

    def run(batches):
        shared.forget()
        made, parts, numbers, found, size = 0, [], _Numbers(), [], 0
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(len(keep))), 0).to_pylist()
            start = 0
            for k, text in enumerate(batch.column(len(keep))):
                found.append(np.fromiter(map(numbers.__getitem__, words(text.as_py())), np.uint32))
                size += sizes[k]
                if size >= PIECE or k + 1 == batch.num_rows:
                    own = batch.select(range(len(keep)))           # a copy, which does not hold the texts
                    parts.append(own.take(pa.array(range(start, k + 1))))
                    start = k + 1
                if size >= PIECE:
                    yield from piece(made, parts, numbers, found)
                    made, parts, numbers, found, size = made + 1, [], _Numbers(), [], 0
        if found:
            yield from piece(made, parts, numbers, found)

    def piece(made, parts, numbers, found):
        names = list(numbers)
        counts = np.bincount(np.concatenate(found), minlength=len(names))
        order = np.argsort(-counts, kind="stable")       # the most frequent words get the least numbers
        ranks = np.empty(len(names), np.uint32)
        ranks[order] = np.arange(len(names), dtype=np.uint32)
        planes = max(1, (len(names).bit_length() + 7) // 8)
        text = "\n".join(names[k] for k in order).encode()
        packed = len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)
        number = TaskContext.get().partitionId() << 32 | made
        kept = pa.Table.from_batches(parts)
        cuts = np.flatnonzero(np.diff(np.cumsum([len(x) for x in found]) // PART)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(found)], strict=True):
            part, mine = kept.slice(start, end - start), [ranks[x] for x in found[start:end]]
            for k in range(planes):
                part = part.append_column(f"_{k}", pa.array([(x >> 8 * k).astype(np.uint8).tobytes() for x in mine], pa.large_binary()))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(part)
            yield pa.record_batch([pa.array([number], pa.int64()), pa.array([b"" if start else packed], pa.binary()),
                                   pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["piece", "words", "rows"])

    return rows.select(*keep, F.col("text").alias("_text")).mapInArrow(run, "piece long, words binary, rows binary")


def _unpacked(packed: bytes) -> list[str]:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], size, "zstd", asbytes=True).decode().split("\n") if size else []


def featured(rows: DataFrame, model: Tables, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``FEATURES``, stored; rows have these columns and ``text``.

    A piece's words stay in it; its distinct grams go to the model's tables, and their values come back to it.
    """
    pieces = shared.stored_by(_pieces(rows, keep), "toxic-pieces", "piece")

    def ask(batches):
        shared.forget()
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                asked = Grams(_unpacked(packed.as_py())).spelled()
                for at in range(0, len(asked), 50_000):
                    part = asked[at:at + 50_000]
                    yield pa.record_batch([pa.array([number] * len(part), pa.int64()), pa.array(range(at, at + len(part)), pa.int32()),
                                           pa.array(part, pa.string())], ["piece", "place", "gram"])

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        shared.forget()
        out = []
        found = _unpacked(max(left.column("words").to_pylist(), key=len, default=bytes(8)))
        made = Grams(found)
        values = np.zeros(len(made.distinct))
        values[right.column("place").to_numpy()] = right.column("value").to_numpy()
        evidence, lengths = made.evidence(values), made.lengths + 1.0
        for stream in left.column("rows"):
            with pa.ipc.open_stream(stream.as_buffer()) as reader:
                for part in reader:
                    codes = (sum(np.frombuffer(x.as_buffer(), np.uint8).astype(np.uint32) << 8 * k for k, x in enumerate(planes))
                             for planes in zip(*part.columns[len(keep):], strict=True))
                    result = np.array([features(evidence[x], lengths[x]) for x in codes]).reshape(-1, len(FEATURES))
                    out.append(pa.table([*part.columns[:len(keep)], *(pa.array(c) for c in result.T)], [*keep, *FEATURES]))
        return pa.concat_tables(out) if out else pa.table({c: [] for c in [*keep, *FEATURES]})

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    schema = ", ".join([kinds, *(f"{c} double" for c in FEATURES)])
    asked = pieces.where("length(words) > 0").select("piece", "words").mapInArrow(ask, "piece long, place int, gram string")
    if model.ratio:
        values = gram_values(asked, model)
        found = asked.join(values, "gram").select("piece", "place", "value")
    else:
        values, found = None, asked.where("false").select("piece", "place", F.lit(0.0).alias("value"))
    out = shared.stored(pieces.groupBy("piece").cogroup(found.groupBy("piece")).applyInArrow(judge, schema), "toxic-features")
    shared.remove(pieces, *([values] if values else []))
    return out


def probability(model: Curve) -> Column:
    z = F.lit(float(model.curve[-1]))
    for name, weight, scale in zip(FEATURES, model.curve, model.scale, strict=False):
        z = z + F.col(name) * F.lit(float(weight / scale))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))


def score(docs: DataFrame, model: Tables) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and ``FEATURES`` for every row.

    A null or empty text has no evidence and gets the curve's base score; without labels of both classes every
    score is that of the default curve, below 0.05. Repeated rows are scored each, null ids are held out, an
    empty table gives an empty one; no column but the text takes part in a score.
    """
    shared.bytes_per_batch(docs.sparkSession, BATCH)
    return (featured(docs.select("doc_id", "text"), model, ["doc_id"])
            .withColumn("score", probability(model.curve))
            .select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES))


def ordinary_documents(docs: DataFrame, model: Tables) -> DataFrame:
    """The rows whose score is below 0.5, in their own columns.

    A score depends on the text alone, so rows are told by the SHA-256 of their text (null: empty). Only rows that a
    fixed-size filter of rejected digests lets through are shuffled to meet them.
    """
    shared.bytes_per_batch(docs.sparkSession, BATCH)
    digest = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    found = featured(docs.select(digest.alias("digest"), "text"), model, ["digest"])
    rejected = shared.stored(found.where(probability(model.curve) >= 0.5).select("digest").distinct(), "toxic-rejected")
    bits = docs.sparkSession.sparkContext.broadcast(shared.id_filter(rejected, "digest"))

    def side(hit: bool):
        def run(batches):
            for batch in batches:
                at = shared.in_filter(bits.value, batch.column(len(batch.columns) - 1).to_numpy())
                yield pa.RecordBatch.from_arrays(batch.filter(pa.array(at == hit)).columns[:-1], batch.schema.names[:-1])
        return run

    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names)
    marked = rows.withColumn("_at", shared.filter_position(F.sha2(F.encode(F.coalesce(names[docs.columns.index("text")], F.lit("")), "UTF-8"), 256)))
    own = F.sha2(F.encode(F.coalesce(names[docs.columns.index("text")], F.lit("")), "UTF-8"), 256)
    clear, met = (marked.mapInArrow(side(hit), rows.schema) for hit in (False, True))
    return clear.unionByName(met.join(rejected, own == rejected["digest"], "left_anti")).toDF(*docs.columns)
