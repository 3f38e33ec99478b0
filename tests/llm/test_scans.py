"""Licence scan, URL filter, fingerprints and sharding on small tables and against plain versions."""

import random
import re
import zlib
from collections import Counter

import pytest

from foliospark.llm import fingerprints, licences, sharding, urls

DOCS = [(1, None), (2, ""), (3, "MIT License.\nApache\tLicense, GNU General Public License"), (4, "cc by cc by"),
        (4, "cc by cc by"), (5, "SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND Apache-2.0"), (None, "x" * 100_000)]


def docs(spark):
    return spark.createDataFrame([(i, t, "clash") for i, t in DOCS], "doc_id long, text string, labels string")


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(k, label) for phrase, label in licences.BASE.items() for k in range(len(words))
              if words[k:k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licence_scan(spark):
    got = licences.scan(docs(spark)).collect()
    assert len(got) == len(DOCS)
    expected = Counter((i, *plain_scan(t)) for i, t in DOCS)
    assert Counter(tuple(r)[:6] for r in got) == expected
    tagged = next(r for r in got if r.doc_id == 5)
    assert tagged.labels == "apache,gpl,mit" and tagged.score == 1.0 and tagged.expression_kinds == "permissive"
    assert licences.scan(docs(spark).where("false")).count() == 0


@pytest.mark.parametrize(("text", "strength"), [
    ("MIT", 1), ("MIT OR GPL-2.0-only", 1), ("MIT AND GPL-2.0-only", 3), ("GPL-2.0+ WITH Classpath-exception-2.0", 2),
    ("MIT OR Apache-2.0 AND AGPL-3.0", 1), ("(MIT OR Apache-2.0) AND AGPL-3.0", 4), ("MIT and others", 1),
    ("AND MIT", None), ("(MIT", None), ("", None), ("MIT OR", None)])
def test_expressions(text, strength):
    found = licences.evaluate_text(text)
    assert (found[0] if found else None) == strength


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://WWW.Example.ORG/es/1?x"), (4, "https://example.org/en/12"),
            (5, "https://badexample.org/es/1"), (6, "https://a.com/de/#f"), (7, "https://a.net/porn/1"),
            (8, "https://a.net/pornography"), (9, "https://free.net/win-bonus"), (10, "https://free.net/free/free"),
            (11, "https://org"), (11, "https://org"), (12, "ftp://u@H.com:80/fr/x")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [(got[k].rule, got[k].verdict) for k in range(1, 13)] == [
        (None, "allow"), (None, "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"),
        ("com/de/", "block"), (None, "block"), (None, "allow"), (None, "block"), (None, "allow"), (None, "allow"),
        (None, "allow")]
    assert (got[3].host, got[3].path, got[1].host, got[2].path) == ("www.example.org", "/es/1", "", "")
    assert got[12].host == "u@h.com:80" and got[12].path == "/fr/x"
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_fingerprints_of_edits(spark):
    rows = [(k, f"line {k} " + " ".join(f"w{(k * 7919 + j * 104729) % 9973}" for j in range(400))) for k in range(40)]
    rows += [(7, rows[7][1]), (100, None), (101, ""), (102, "abc"), (None, "no id")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(fingerprints.against_edits(table, intervals=4).collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(rows)
    import hashlib
    for k, (row, (doc_id, text)) in enumerate(zip(got, ordered, strict=True)):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        changed = text[:len(text) - n] + following[:n]
        assert (row.doc_id, row.n_chars) == (doc_id, len(text))
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.fingerprint == fingerprints.fingerprint(text)
        assert row.near_next == fingerprints.likeness(row.fingerprint, fingerprints.fingerprint(following))
    long = [r for r in got if r.n_chars > 1000]
    assert all(r.near_edited > 0.5 for r in long) and sum(r.near_next for r in long) < 5
    one = fingerprints.against_edits(table.where("doc_id = 102")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.against_edits(table.where("false")).count() == 0


def test_signature_parts():
    assert fingerprints.common("abcbdab", "bdcaba") == 4
    assert fingerprints.likeness("2::", "2::") == 1.0 and fingerprints.likeness("2::", "2:ab:a") == 0.0
    assert fingerprints.likeness("3:abcdefgh:abcd", "3:abcdefgx:abcd") > 0.8
    assert fingerprints.likeness("3:abcdefgh:abcd", "7:abcdefgh:abcd") == 0.0
    assert fingerprints.fingerprint("a" * 50_000).count(":") == 2


def test_sharding(spark):
    rows = [(k, "x" * (k % 90)) for k in range(3000)] + [(5000, None), (None, "n"), (1, "x"), (1, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(table, slots=512).collect()
    assert len(got) == len(rows)
    sizes, places = Counter(), {}
    for r in got:
        sizes[r.shard] += r["size"]
        places.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.01 * min(sizes.values())
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len(t or "") + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    moved = [r for r in got if r.next_shard != r.shard]
    assert 0 < len(moved) < 0.2 * len(got) and {r.next_shard for r in moved} == {8}
    assert sharding.shard(table.where("false")).count() == 0


def plain_strength(tokens):
    """Recursive descent: or < and < with."""
    def operand():
        token = tokens.pop(0)
        if token == "(":
            found = either()
            assert tokens.pop(0) == ")"
            return found
        name = licences.family(token)
        return licences.STRENGTH.get(name, licences.UNKNOWN), {name}

    def exception():
        found = operand()
        while tokens and tokens[0].lower() == "with":
            tokens.pop(0)
            operand()
            found = found[0] - (found[0] in (2, 3)), found[1]
        return found

    def both():
        found = exception()
        while tokens and tokens[0].lower() == "and":
            tokens.pop(0)
            right = exception()
            found = max(found[0], right[0]), found[1] | right[1]
        return found

    def either():
        found = both()
        while tokens and tokens[0].lower() == "or":
            tokens.pop(0)
            right = both()
            found = min(found[0], right[0]), found[1] | right[1]
        return found
    return either()


def test_expressions_equal_a_plain_evaluator():
    rng = random.Random(8)
    names = ["MIT", "GPL-2.0-only", "LGPL-2.1+", "OpenSSL", "JSON", "Apache-2.0", "MPL-2.0", "CC0-1.0", "Foo", "AGPL-3.0", "LicenseRef-own"]

    def expression(depth):
        if depth == 0 or rng.random() < 0.3:
            return [rng.choice(names)]
        if rng.random() < 0.3:
            return ["(", *expression(depth - 1), ")"]
        word = rng.choice(["or", "AND", "and", "OR"])
        if rng.random() < 0.15:
            return [rng.choice(names), "WITH", "Classpath-exception-2.0"]
        return [*expression(depth - 1), word, *expression(depth - 1)]

    for _ in range(2000):
        tokens = expression(4)
        assert licences.evaluate_text(" ".join(tokens)) == plain_strength(list(tokens)), tokens


@pytest.mark.parametrize("line, labels, kind", [
    ("MIT AND OpenSSL", {"mit", "openssl"}, "permissive"), ("MIT AND Frobnic", {"mit", "frobnic"}, "restricted"),
    ("(MIT OR Beerware)", {"mit", "beerware"}, "permissive"), ("(MIT OR Whatever) and more", {"mit", "whatever"}, "permissive"),
    ("MIT and Others may use it", {"mit"}, "permissive"), ("MIT and others", {"mit"}, "permissive"), ("JSON", {"json"}, "permissive"), ("MIT or", set(), ""), ("(MIT", set(), ""),
    ("MIT) or GPL", set(), ""), ("Unheard OR MIT", {"unheard", "mit"}, "permissive")])
def test_operands_behind_a_tag(line, labels, kind):
    found = licences.Scanner().scan(f"x\n// SPDX-License-Identifier: {line}\nGPL-3.0 and more")
    assert (set(filter(None, found[5].split(","))), found[7]) == (labels, kind)


@pytest.mark.parametrize("piece", ["// SPDX-License-Identifier: MIT or GPL-2.0-only\n", "SPDX-License-Identifier: (MIT or ", "license identifier mit and ("])
def test_many_tags_take_time_in_proportion(piece):
    import time
    scanner, text = licences.Scanner(), piece * (5_000_000 // len(piece))
    started = time.process_time()
    scanner.scan(text)
    assert time.process_time() - started < 20
