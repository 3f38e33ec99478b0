"""Line labelling: counts against plain loops, decoding and slopes against enumeration, verdicts against labels."""

import random
import re
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from foliospark.llm import lines

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k:k + 5]), []).append(k)
    covered = {k + j for found in windows.values() if len(found) > 1 for k in found for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def some_texts():
    rng = random.Random(1)
    out = [None, "", " ", "\n", "\n\n a", "a", "é é", "a b c d e a b c d e", "a b c d e\na b c d e\n\n \nx", "x\x0by\x0cz\r\nx\x0by\x0cz\r\n", "日 本 語 x # * |", "  a",
           "tail\n", "w " * 3000, "same\n" * 300, " lead", "lead ", "a\x00b a\x00b"]
    for _ in range(400):
        pieces = [rng.choice(["a", "b", "cd", "É", "語x", "#", "|", "!", "Q9."]) + rng.choice([" ", "\n", "\t", "  ", " \n ", "\r\n"]) for _ in range(rng.randint(0, 60))]
        out.append("".join(pieces))
    return out


@pytest.mark.parametrize("size", [64, lines.SLICE])
def test_counts_equal_plain_loops(spark, monkeypatch, size):
    monkeypatch.setattr(lines, "SLICE", size)
    texts = some_texts()
    table = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)] + [(None, "a", 1, "x")], "doc_id long, text string, kept int, n_words string")
    rows = lines.judge(table, lines.Field()).collect()
    got = {r.doc_id: tuple(r)[1:7] for r in rows}
    assert len(rows) == len(texts) + 1
    for k, text in enumerate(texts):
        assert got[k] == counts(text), text
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert lines.judge(table.where("false"), lines.Field()).count() == 0


def test_windows_with_equal_sums_are_told_apart(monkeypatch):
    class Ones:
        def integers(self, *_):
            return np.ones(6, np.int64)
    monkeypatch.setattr(lines.np.random, "default_rng", lambda _: Ones())
    for text in some_texts():
        found = lines.measure(pa.array([text, "a b c d e f g"], pa.string()))
        assert found.n_repeat_words[0] == counts(text)[4], text


def random_field(rng):
    model = lines.Field()
    model.weights, model.moves = rng.normal(size=len(lines.FEATURES) + 1), rng.normal(size=(2, 2))
    return model


def path_score(model, score, path):
    return sum(s * y for s, y in zip(score, path, strict=True)) + sum(model.moves[a, b] for a, b in zip(path, path[1:], strict=False))


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(2)
    for _ in range(60):
        model, sizes = random_field(rng), rng.integers(1, 8, 4)
        text_of, x = np.repeat([0, 2, 3, 7], sizes), rng.normal(size=(sizes.sum(), len(lines.FEATURES)))
        got = lines.decode(model, x, text_of)
        for t in (0, 2, 3, 7):
            score = model.evidence(x)[text_of == t]
            best = max(product((0, 1), repeat=len(score)), key=lambda p: path_score(model, score, p))  # noqa: B023
            assert tuple(got[text_of == t].astype(int)) == best


def test_likelihood_and_slopes():
    rng = np.random.default_rng(3)
    model, text_of = random_field(rng), np.repeat([0, 1, 2], [3, 1, 4])
    x, labels = rng.normal(size=(8, len(lines.FEATURES) + 1)), rng.integers(0, 2, 8)
    value, by_weight, by_move = lines.likelihood(model, x, text_of, labels)
    score, expected = x @ model.weights, 0.0
    for t in range(3):
        s, y = score[text_of == t], labels[text_of == t]
        expected += np.log(sum(np.exp(path_score(model, s, p)) for p in product((0, 1), repeat=len(s)))) - path_score(model, s, y)
    assert value == pytest.approx(expected)
    for part, slope in ((model.weights, by_weight), (model.moves.reshape(-1), by_move.ravel())):
        for k in range(len(part)):
            part[k] += 1e-5
            up = lines.likelihood(model, x, text_of, labels)[0]
            part[k] -= 2e-5
            down = lines.likelihood(model, x, text_of, labels)[0]
            part[k] += 1e-5
            assert slope[k] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_field_on_documents_it_was_not_fitted_on(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = lines.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = lines.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = [r for r in rows if r.quality and not r.base_failed], [r for r in rows if not r.quality]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)
    assert lines.fit(docs, labels.where("quality = 1")).weights[-1] == 1.0
    assert lines.fit(docs.where("false"), labels).weights[-1] == 1.0
