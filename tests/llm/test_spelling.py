"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from foliospark.llm import acceptors, spelling


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def some_words(seed, letters, count, sizes):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(count)})


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_composition_finds_every_pair_once(depth):
    words = some_words(1, "abcé", 1200, (3, 7))
    machine = acceptors.Acceptor([w.encode("latin-1") for w in words])
    found = Counter(frozenset(p) for p in zip(*(x.tolist() for x in acceptors.near_pairs(machine, np.full(len(words), depth))), strict=True))
    expected = Counter(frozenset((i, j)) for i, a in enumerate(words) for j, b in enumerate(words[:i]) if near(a, b) and a[:depth] == b[:depth])
    assert found == expected
    assert len(machine.node_of) < len(machine.low) / 2


def test_acceptor_is_minimal():
    words = [a + b for a in ("", "x", "yy") for b in ("abcd", "abce", "bcd")]
    machine = acceptors.Acceptor(sorted(w.encode() for w in words))
    tails = {frozenset(w[k:] for w in words if w.startswith(p[:k])) for p in words for k in range(len(p) + 1)}
    assert len(machine.node_of) == len(tails)


@pytest.mark.parametrize("cell", [5, 60, 20_000])
def test_near_words_whatever_the_cell(spark, cell):
    words = some_words(2, "abé", 250, (1, 6)) + [f"commonbeginning{w}" for w in some_words(3, "ab", 60, (1, 7))] + ["commonbeginning"]
    rng = random.Random(4)
    counts = {w: rng.randint(2, 9) for w in words}
    got = {r.word: (r.n, r.n_near, r.near_n, r.near) for r in spelling.near_words(
        spark.createDataFrame([(w, n, 0) for w, n in counts.items()], "word string, n long, depth int"), cell).collect()}
    expected = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        expected[w] = n, len(others), counts.get(best), best
    assert got == expected


def plain(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] < 10 * n:
            best = None
        out[w] = best, n, len(others), counts.get(best)
    rows = set()
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, form, root, n, n_near, form_n))
    return rows


def test_group_equals_brute_force(spark):
    rng = random.Random(5)
    words = ["variant", "Variante", "variantes", "ÉCOLIÈRES", "écolières", "écolieres", "abcdefgh", "abcdefg", "abcdefgi", "straßen÷×"]
    chain = [("chaining", 2), ("chainingx", 25), ("chainingxy", 260)]
    rows = [(k, " ".join(rng.choices(words, [400, 3, 40, 4, 50, 2, 30, 300, 1, 9], k=40))) for k in range(80)]
    rows += [(1000, " ".join(f"{w},{w};" for w, n in chain for _ in range(n))), (None, "variant variant nullable nullable"), (5, None), (6, ""),
             (7, "variant"), (7, "variant"), (8, "x" * 20_000 + " " + "x" * 20_000), (9, "日本語variant variant日本語 ＡＢＣＤＥＦＧ")]
    table = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.group(table)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain(rows)
    assert any(r[2] not in (r[0], r[1]) for r in found)
    assert spelling.group(table.where("false")).count() == 0
