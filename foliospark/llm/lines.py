"""Quality by line sequence labelling: a linear-chain conditional random field marks each line content or boilerplate.

A line is described by its own characters and words and by what the text repeats (``FEATURES``); lines without a word
are left out of the chain. The field has one weight a feature and one a transition. It is fitted to line labels drawn
from document labels: every line of a good document is content; a line of a bad one is content if a logistic curve
over single lines, fitted to the documents' labels, says so. Viterbi decoding labels the lines of a text; the share of
its words' characters in content lines decides whether it stays.

Counts and features are array passes over the bytes of many texts at once; the chains of all texts of a slice advance
together, one line of each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import shared

FEATURES = ("words", "symbols", "exclamations", "capitals", "digits", "repeated", "duplicate", "word_length", "stops", "ends")
SHARE = 0.5
LEAST_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5
# Labelled documents of each class the field is fitted on, at most, and lines of such a document (longer ones are not taken).
SAMPLE, SAMPLE_LINES = 2_000, 500
# Bytes of text worked on at a time; a longer text is a slice of its own.
SLICE = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _of(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(characters, np.uint8)] = True
    return table


_SYMBOL, _EXCLAMATION, _STOP, _END = _of(b"#*$%&|<>"), _of(b"!?"), _of(b".,;:"), _of(b".!?\"')")
_CAPITAL, _DIGIT = _of(bytes(range(65, 91))), _of(bytes(range(48, 58)))
_POINT = np.arange(256) & 0xC0 != 0x80                  # first byte of a code point


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def _codes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number for each of the strings that lie one after another in ``data``; equal ones get equal numbers."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return strings.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _again(group: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether an earlier place of the same group has the same code."""
    order = np.lexsort((code, group))
    out = np.zeros(len(code), bool)
    out[order[1:]] = (group[order[1:]] == group[order[:-1]]) & (code[order[1:]] == code[order[:-1]])
    return out


def _repeated(text_of: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether a word lies in a window of ``WINDOW`` words that its text has twice or more.

    Windows are compared through sums of random multiples; those that meet are held against each other word by word.
    """
    out = np.zeros(len(code), bool)
    if len(code) <= WINDOW:
        return out
    last = len(code) - WINDOW + 1
    whole = text_of[:last] == text_of[WINDOW - 1:]
    factors = np.random.default_rng(12).integers(1, 1 << 62, WINDOW + 1).astype(np.uint64) | np.uint64(1)
    sums = text_of[:last].astype(np.uint64) * factors[WINDOW]
    for k in range(WINDOW):
        sums += code[k:last + k].astype(np.uint64) * factors[k]
    places = np.flatnonzero(whole)
    order = places[np.argsort(sums[places], kind="stable")]
    met = np.flatnonzero(sums[order[1:]] == sums[order[:-1]])
    if not len(met):
        return out
    columns = [text_of[:last], *(code[k:last + k] for k in range(WINDOW))]
    same = np.logical_and.reduce([c[order[met]] == c[order[met + 1]] for c in columns])
    if not same.all():                                  # different windows with one sum
        order = places[np.lexsort([c[places] for c in columns])]
        met = np.flatnonzero(np.logical_and.reduce([c[order[1:]] == c[order[:-1]] for c in columns]))
    marks = np.zeros(len(code) + 1, np.int64)
    found = np.unique(np.concatenate((order[met], order[met + 1])))
    marks[found] += 1
    marks[found + WINDOW] -= 1
    return np.cumsum(marks)[:-1] > 0


@dataclass
class Measured:
    """Of each text: the counts; of its lines that have words, in order: features and characters of words."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    text_of: np.ndarray
    features: np.ndarray
    chars: np.ndarray

    @property
    def failed(self) -> np.ndarray:
        return (self.n_words < LEAST_WORDS) | (100 * self.n_repeat_words > REPEATED_PERCENT * self.n_words)


def measure(texts: pa.Array) -> Measured:
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    space = _SPACE[data]
    solid = ~space
    start, end = solid.copy(), solid.copy()
    start[1:] &= space[:-1]
    end[:-1] &= space[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]   # a text's first byte starts a word, its last ends one
    start[firsts] = solid[firsts]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[lasts] = solid[lasts]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    upto = np.searchsorted(starts, offsets)
    n_words = np.diff(upto)
    text_of_word = np.repeat(np.arange(n), n_words)
    code = _codes(data[solid], ends - starts)
    repeated = _repeated(text_of_word, code)

    newlines = np.flatnonzero(data == 10)
    line_of_word = np.searchsorted(newlines, starts) + text_of_word
    opens = np.flatnonzero(np.diff(line_of_word, prepend=-1))
    text_of = text_of_word[opens]
    at = np.searchsorted(newlines, starts[opens])
    begin = np.maximum(offsets[:-1][text_of], np.concatenate(([0], newlines + 1))[at]) if len(opens) else opens
    close = np.minimum(offsets[1:][text_of], np.concatenate((newlines, [len(data)]))[at]) if len(opens) else opens
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, begin, 1)
    np.add.at(inside, close, -1)
    duplicate = _again(text_of, _codes(data[np.cumsum(inside[:-1], dtype=np.int8) > 0], close - begin))

    points, symbols = _sums(_POINT[data] & solid), _sums(_SYMBOL[data])
    words = np.diff(np.append(opens, len(starts)))
    chars = points[close] - points[begin]

    def share(table: np.ndarray) -> np.ndarray:
        found = _sums(table[data])
        return (found[close] - found[begin]) / np.maximum(chars, 1)

    repeats = _sums(repeated)
    tails = ends[np.append(opens[1:], len(starts)) - 1] - 1 if len(opens) else opens
    features = np.column_stack([
        np.log1p(words), (symbols[close] - symbols[begin]) / np.maximum(chars, 1), share(_EXCLAMATION), share(_CAPITAL), share(_DIGIT),
        (repeats[np.append(opens[1:], len(starts))] - repeats[opens]) / np.maximum(words, 1) if len(opens) else opens,
        duplicate, np.log(np.maximum(chars, 1) / np.maximum(words, 1)), share(_STOP), _END[data[tails]] if len(opens) else opens]).astype(np.float64)
    return Measured(n_words, np.diff(points[offsets]), np.diff(symbols[offsets]), np.bincount(text_of[duplicate], minlength=n),
                    repeats[upto[1:]] - repeats[upto[:-1]], text_of, features, chars)


@dataclass
class Field:
    """Weight of each feature and of a line as such, for content; weights of the transitions from and to boilerplate 0, content 1."""

    weights: np.ndarray = field(default_factory=lambda: np.array([0.0] * len(FEATURES) + [1.0]))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    middle: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))

    def evidence(self, features: np.ndarray) -> np.ndarray:
        return (features - self.middle) / self.scale @ self.weights[:-1] + self.weights[-1]


class _Chains:
    """Lines of many texts by their place: the texts with most lines first, so that those still going are a prefix."""

    def __init__(self, text_of: np.ndarray):
        self.begin = np.flatnonzero(np.diff(text_of, prepend=-1))
        sizes = np.diff(np.append(self.begin, len(text_of)))
        order = np.argsort(-sizes, kind="stable")
        self.begin, sizes = self.begin[order], sizes[order]
        self.steps = int(sizes[0]) if len(sizes) else 0
        self.going = np.searchsorted(-sizes, -np.arange(self.steps), side="left") if self.steps else np.zeros(0, int)
        self.last = self.begin + sizes - 1

    def lines(self, step: int) -> np.ndarray:
        return self.begin[:self.going[step]] + step


def decode(model: Field, features: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Viterbi labels of the lines, True for content; of equal paths the one with content later on."""
    chains, score, moves = _Chains(text_of), model.evidence(features), model.moves
    came = np.zeros((2, len(score)), np.int8)
    best = np.zeros((2, len(chains.begin)))
    for step in range(chains.steps):
        at = chains.lines(step)
        now = best[:, :len(at)]
        if step:
            options = [now + moves[:, [k]] for k in (0, 1)]
            for k in (0, 1):
                came[k, at] = options[k][1] >= options[k][0]
            now = np.stack([np.maximum(*o) for o in options])
        now[1] += score[at]
        best[:, :len(at)] = now
    labels = np.zeros(len(score), np.int8)
    labels[chains.last] = best[1] >= best[0]
    for step in range(chains.steps - 1, 0, -1):
        at = chains.lines(step)
        labels[at - 1] = came[labels[at], at]
    return labels.astype(bool)


def likelihood(model: Field, x: np.ndarray, text_of: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood of the labels, and its slopes by weights and transitions. x: scaled features and a one."""
    chains, score, moves = _Chains(text_of), x @ model.weights, model.moves
    forward = np.zeros((2, len(score)))
    for step in range(chains.steps):
        at = chains.lines(step)
        if step:
            before = forward[:, at - 1]
            forward[:, at] = np.stack([np.logaddexp(before[0] + moves[0, k], before[1] + moves[1, k]) for k in (0, 1)])
        forward[1, at] += score[at]
    backward, expected = np.zeros((2, len(score))), np.zeros((2, 2))
    total = np.logaddexp(*forward[:, chains.last])
    for step in range(chains.steps - 1, 0, -1):
        at = chains.lines(step)
        onward = backward[:, at] + np.stack([np.zeros(len(at)), score[at]])
        for j in (0, 1):
            both = [forward[j, at - 1] + moves[j, k] + onward[k] for k in (0, 1)]
            for k in (0, 1):
                expected[j, k] += np.exp(both[k] - total[:len(at)]).sum()
            backward[j, at - 1] = np.logaddexp(moves[j, 0] + onward[0], moves[j, 1] + onward[1])
    chance = 1 / (1 + np.exp(np.clip(forward[0] + backward[0] - forward[1] - backward[1], -700, 700)))
    same = text_of[1:] == text_of[:-1]
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (labels[:-1][same], labels[1:][same]), 1)
    value = total.sum() - (score * labels).sum() - (pairs * moves).sum()
    return float(value), x.T @ (chance - labels), expected - pairs


def fit_field(features: np.ndarray, text_of: np.ndarray, good: np.ndarray, penalty: float = 1e-3) -> Field:
    """``good``: of each line, whether its document is. Single lines first, then the chain."""
    model = Field()
    model.middle, model.scale = features.mean(0), np.maximum(features.std(0), 1e-6)
    x = np.column_stack([(features - model.middle) / model.scale, np.ones(len(features))])
    alone = np.arange(len(features))
    _descend(model, x, alone, good.astype(np.int64), penalty, chained=False)
    labels = (good | (x @ model.weights >= 0)).astype(np.int64)
    if labels.min() != labels.max():
        _descend(model, x, text_of, labels, penalty, chained=True)
    return model


def _descend(model: Field, x: np.ndarray, text_of: np.ndarray, labels: np.ndarray, penalty: float, chained: bool, steps: int = 200) -> None:
    """Limited-memory quasi-Newton steps on the penalised likelihood a line."""
    size = len(model.weights)

    def slope(p: np.ndarray) -> tuple[float, np.ndarray]:
        model.weights, model.moves = p[:size], p[size:].reshape(2, 2)
        value, by_weight, by_move = likelihood(model, x, text_of, labels)
        by_move = by_move if chained else np.zeros((2, 2))
        return value / len(x) + penalty / 2 * (p @ p), np.concatenate((by_weight, by_move.ravel())) / len(x) + penalty * p

    p = np.concatenate((model.weights, model.moves.ravel()))
    value, g = slope(p)
    memory: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, kept = -g, []
        for s, y in reversed(memory):
            a = s @ d / (s @ y)
            kept.append(a)
            d = d - a * y
        if memory:
            s, y = memory[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(memory, reversed(kept), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        length = 1.0
        while length > 1e-10:
            new_value, new_g = slope(p + length * d)
            if new_value <= value + 1e-4 * length * (g @ d):
                break
            length /= 2
        else:
            break
        s, y = length * d, new_g - g
        p, value, g = p + s, new_value, new_g
        if s @ y > 1e-12:
            memory = [*memory[-7:], (s, y)]
        if np.abs(g).max() < 1e-6:
            break
    model.weights, model.moves = p[:size].copy(), p[size:].reshape(2, 2).copy()


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows of about ``SLICE`` bytes."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // SLICE)) + 1
    ends = [*cuts.tolist(), len(texts)]
    return [(a, b) for a, b in zip([0, *ends], ends, strict=False) if a < b]


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """The field of a sample of labelled documents: the first ``SAMPLE`` ids of each class in order of a hash.

    A document with several labels is good if one says so; null ids and labels do not count. Without both classes the
    field is one that takes every line for content.
    """
    shared.bytes_per_batch(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = [known.where(f"quality {test}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for test in ("= 0", "<> 0")]
    wanted = F.broadcast(sample[0].unionByName(sample[1]).select(F.col("doc_id").alias("_id"), (F.col("quality") != 0).alias("good")))
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("_id")).select("good", "text")

    def run(batches):
        for batch in batches:
            for a, b in _slices(batch.column(1)):
                found = measure(batch.column(1).slice(a, b - a))
                for k, good in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    mine = found.features[found.text_of == k]
                    if 0 < len(mine) <= SAMPLE_LINES:
                        yield pa.record_batch([pa.array([good]), pa.array([mine.tobytes()], pa.binary())], ["good", "lines"])

    found = sorted((r.good, bytes(r.lines)) for r in rows.mapInArrow(run, "good boolean, lines binary").collect())
    if len({good for good, _ in found}) < 2:
        return Field()
    features = [np.frombuffer(x, np.float64).reshape(-1, len(FEATURES)) for _, x in found]
    sizes = [len(x) for x in features]
    return fit_field(np.concatenate(features), np.repeat(np.arange(len(sizes)), sizes), np.repeat([good for good, _ in found], sizes))


def judge(docs: DataFrame, model: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, content_share`` of every row.

    ``n_lines`` counts lines with a word; ``content_share`` is null without any. A null or empty text has zeros and is
    not kept. Repeated rows are judged each, an empty table gives an empty one, other columns are not read. One narrow
    stage, no shuffle; what is sent along is one weight a feature.
    """
    shared.bytes_per_batch(docs.sparkSession)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "content_share"]

    def run(batches):
        for batch in batches:
            for a, b in _slices(batch.column(1)):
                found = measure(batch.column(1).slice(a, b - a))
                content = decode(model, found.features, found.text_of)
                lines = np.bincount(found.text_of, minlength=b - a)
                share = np.bincount(found.text_of, found.chars * content, b - a) / np.maximum(found.word_chars, 1)
                counts = [pa.array(c.astype(np.int64)) for c in (found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words)]
                yield pa.record_batch([batch.column(0).slice(a, b - a), *counts, pa.array(found.failed), pa.array(~found.failed & (share >= SHARE)),
                                       pa.array(lines.astype(np.int64)), pa.array(share, mask=lines == 0)], names)

    selected = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    return selected.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                    "base_failed boolean, kept boolean, n_lines long, content_share double")
