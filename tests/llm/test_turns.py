"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest

from foliospark.llm import turns

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, initials of the edits, repaired rows): least of all sequences of edits, by cost and then by initials.

    rows: (role, text, must_go, truncated).
    """
    best = {q: (c, "I" * (c // 2), [("user", ""), ("assistant", "")][{"": 2, "s": 0, "u": 1, "a": 2}[q]:][:c // 2])
            for q, c in (("", 0), ("s", 4), ("u", 2), ("a", 0))}
    for role, text, must_go, truncated in reversed(rows):
        now = {}
        for q in best:
            options = [(best[q][0] + 3, "D" + best[q][1], best[q][2])]
            if not must_go:
                for name, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    onward = NEXT.get((q, name[:1]))
                    if onward:
                        cost, edits, out = best[onward]
                        options.append((cost + price + truncated, letter + edits, [(name, text), *out]))
            now[q] = min(options, key=lambda x: x[:2])
        for _ in range(3):
            for q in now:
                for name in ("user", "assistant"):
                    onward = NEXT.get((q, name[0]))
                    if onward:
                        cost, edits, out = now[onward]
                        now[q] = min(now[q], (cost + 2, "I" + edits, [(name, ""), *out]), key=lambda x: x[:2])
        best = now
    return best[""]


def plain(table):
    conversations = {}
    for conv, turn, role, text in table:
        mine = conversations.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            fault = None
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            if not body:
                fault = 0
            elif (role, text) in seen:
                fault = 1
            elif body[-1] not in ".!?":
                fault = 2
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), int(fault == 2)))
        numbers = [r[0] for r in rows if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, repaired = cheapest(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return out


@pytest.fixture(scope="module")
def repairer():
    return turns.Repairer(turns.Blocks())


def test_block_tables_equal_single_steps(repairer):
    blocks = repairer.b
    rng = random.Random(1)
    assert len(blocks.vectors) < 500
    for _ in range(300):
        vector, block = rng.randrange(len(blocks.vectors)), [rng.randrange(9) for _ in range(turns.BLOCK)]
        now, total = vector, 0
        for symbol in reversed(block):
            now, least = blocks.one[now, symbol]
            total += least
        code = sum(s * 9 ** (turns.BLOCK - 1 - k) for k, s in enumerate(block))
        assert (blocks.to[vector, code], blocks.cost[vector, code]) == (now, total)


def test_edits_are_cheapest_and_least(repairer):
    roles, rng = ("user", "assistant", "system", "tool"), random.Random(2)
    some = [list(x) for n in range(4) for x in product(range(9), repeat=n)] + [[rng.randrange(9) for _ in range(rng.randint(4, 30))] for _ in range(500)]
    for symbols in some:
        rows = [(roles[s % 4], "x", s == 8, int(4 <= s < 8)) for s in symbols]
        x = np.array(symbols, np.int64)
        vector, total, behind = repairer.backward(x, 0)
        audit, state = repairer.forward(x, turns.START, behind)
        audit += "I" * (turns.END[state] // 2)
        assert (repairer.b.vectors[vector][turns.START] + total, audit) == cheapest(rows)[:2], symbols


def table(seed=3):
    rng = random.Random(seed)
    words = ["Yes.", "No", "Why? ", " ", "", "So it is!", "ok\n", None, " ", "Fine.\x0b", "É."]
    rows = [(conv, turn, rng.choice(["user", "assistant", "system", "tool", None, "", "u", "Ärger"] if conv % 7 == 0 else ["user", "assistant", "user", "assistant", "system"]),
             rng.choice(words) if rng.random() < 0.5 else f"text {rng.random()}.") for conv in range(120) for turn in range(rng.randint(1, 14))]
    rows += [(None, k, "user" if k % 2 == 0 else "assistant", f"n{k}.") for k in range(6)] + [(500, None, "user", "a."), (500, None, None, None), (500, 3, "assistant", "b")]
    rows += [rows[5]] * 3 + [(900, 7, "user", "same."), (900, 7, "user", "same."), (900, 7, "assistant", "other.")]
    dropped = next(k for k in range(1000, 9999) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "gone.")]


@pytest.mark.parametrize("bits", [16, 2])
def test_repair_equals_plain_search(spark, monkeypatch, bits):
    """With segments of four rows most conversations are cut."""
    monkeypatch.setattr(turns, "SEGMENT_BITS", bits)
    rows = table()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, sha string")
    got = turns.repair(df.repartition(5))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == sorted(plain(rows), key=repr)
    assert turns.repair(df.where("false")).count() == 0


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(turns, "SEGMENT_BITS", 6)
    rng = random.Random(4)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "no"]) + str(rng.randrange(3000)) + rng.choice(["", "."])) for k in range(3000)]
    rows += [(2, 0, "user", "hi."), (2, 1, "assistant", "yo.")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    assert sorted(map(tuple, turns.repair(df).collect())) == sorted(plain(rows))
