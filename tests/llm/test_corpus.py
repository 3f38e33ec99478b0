"""Joins, toxicity, mixing and the pipeline on small tables and against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from foliospark.llm import components, grid_join, mixing, ngram_join, toxicity


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(40)] + [(rng.randint(100, 200), rng.randint(100, 200)) for _ in range(60)] + [(500, 500)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = plain_components({n for x in links for n in x}, links)
    assert all(expected[n] == c for n, c in got.items())
    assert set(got) == {n for a, b in links if a != b for n in (a, b)}


def test_grid_join_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 24)).astype(np.float32)
    x[200:300] = x[:100] + rng.normal(size=(100, 24)).astype(np.float32) * 0.12
    x[300:420] = x[5] + rng.normal(size=(120, 24)).astype(np.float32) * 0.2
    x[420:440] = x[7] * 3
    rows = [(int(k) * 3, v.tolist()) for k, v in enumerate(x)]
    rows += [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] * 24), (9003, [1.0, None]), (9004, [float("inf")]),
             (9005, []), (None, [1.0] * 24), (0, x[0].tolist()), (9006, [1.0]), (9007, [2.0, 0.0])]
    table = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, n_links string")
    got = grid_join.join(table.repartition(3)).collect()
    assert len(got) == len(rows)
    good = [r for r in rows if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    m = np.zeros((len(good), 24))
    for k, (_, v) in enumerate(good):
        m[k, :len(v)] = np.float32(v)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [r[0] for r in good]
    roots = plain_components({r[0] for r in rows}, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    expected = Counter((ids[k], int(near[k].sum()), roots[ids[k]], roots[ids[k]] == ids[k]) for k in range(len(good)))
    expected += Counter((i, 0, i, True) for i in (9000, 9001, 9002, 9003, 9004, 9005, None))
    assert Counter(map(tuple, got)) == expected
    assert near.sum() > 10_000
    assert grid_join.join(table.where("false")).count() == 0


def grams(text, n=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def corpus():
    rng = random.Random(9)
    words = [f"w{k}" for k in range(500)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(30)]
    rows = [(10 * k, " ".join(t)) for k, t in enumerate(base)]
    for k in range(400):
        t = list(base[0] if k < 320 else rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((1000 + k, " ".join(t)))
    return rows + [(1, None), (2, ""), (3, ""), (4, "one two"), (5, "One, two!"), (6, "one"), (None, "one two"),
                   (0, rows[0][1]), (7, "long " * 30_000)]


def test_ngram_join_equals_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, class_id string")
    got = ngram_join.join(table.repartition(4)).collect()
    known = [r for r in rows if r[0] is not None]
    sets = [grams(t) for _, t in known]
    links = [(a, b) for a in range(len(known)) for b in range(a) if (known[a][1] or "") == (known[b][1] or "")
             or sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    counts = Counter(k for link in links for k in link)
    roots = plain_components({r[0] for r in known}, [(known[a][0], known[b][0]) for a, b in links])
    expected = Counter((i, roots[i], counts[k], roots[i] == i) for k, (i, _) in enumerate(known))
    expected[(None, None, 0, True)] += 1
    assert Counter(map(tuple, got)) == expected
    assert ngram_join.join(table.where("false")).count() == 0
    kept = ngram_join.kept_documents(table).collect()
    assert Counter(r.doc_id for r in kept) == Counter({*(r for r in roots.values()), None})


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows(0.8, 0.9999)
    assert bands * rows <= 256 and (1 - 0.8 ** rows) ** bands <= 1e-4


def test_kneser_ney_sums_to_one():
    table = Counter()
    for word in ("banana", "bandana", "band"):
        for gram in toxicity.grams(word):
            table[gram] += 1
    found, rest = toxicity._probabilities({g: (n, n, n) for g, n in table.items()}, 0, None)
    assert all(0 < p < 1 or math.isclose(p, 1) for p in found.values()) and all(0 < r <= 1 for r in rest.values())
    model = toxicity.build({g: (n, 0) if "nd" in g else (n, n) for g, n in table.items()})
    assert model.word("band") > model.word("banana") and model.word("") == model.word("")


def toxic_table(spark, n=600):
    rng = random.Random(1)
    words = ["the", "of", "and", *("".join(rng.choice("aeioklmnrst") for _ in range(rng.randint(3, 9))) for _ in range(900))]
    bad = ["blargish", "zwofter", "grumpfel"]
    rows = []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        toxic = k % 6 == 0
        for _ in range(4 if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(bad)
        rows.append((k, " ".join(text), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_table(spark)
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(9001, None, "s"), (9002, "", None), (None, "x", "s"),
                                                                     (9003, "the " * 50_000, "s"), (0, rows[0][1], "s")],
                                 "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(9001, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + 5
    by_id = {r.doc_id: r for r in got}
    held = [(by_id[i], x) for i, _, x in rows if by_id[i].held_out]
    assert len(held) > 60 and sum(r.predicted == x for r, x in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    kept = toxicity.ordinary_documents(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}
    none = toxicity.fit(docs, labels.where("false"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(docs.where("false"), model).count() == 0


def mixed_rows():
    rng = random.Random(2)
    return [(k, " ".join(["w"] * rng.randint(1, 40)), "big" if k % 3 else ("small" if k % 2 else None)) for k in range(900)] + \
        [(901, None, "big"), (902, "", "none"), (None, "a b", "big"), (3, "x y", "big")]


def test_mixing_meets_its_target(spark):
    docs = spark.createDataFrame([(*r, 1) for r in mixed_rows()], "doc_id long, text string, source string, epoch int")
    target = mixing.Target(block=200)
    got = mixing.mix(docs, target).collect()
    own, mixed = Counter(), Counter()
    for _, t, s in mixed_rows():
        own[s] += len((t or "").split())
    for r in got:
        mixed[r.source] += r.n_tokens
    whole = sum(own.values())

    def entropy(c):
        return -sum(n / sum(c.values()) * math.log(n / sum(c.values())) for n in c.values() if n)
    used = Counter({s: n for s, n in own.items() if n})
    wanted = entropy(used) + 0.5 * (math.log(len(used)) - entropy(used))
    assert abs(entropy(mixed) - wanted) < 0.02 and abs(sum(mixed.values()) - whole) < 0.02 * whole
    times = Counter((r.doc_id, r.source, r.n_tokens) for r in got)
    assert max(times.values()) <= 5 and "none" not in mixed
    for s in used:
        counts = {times[(i, s, len((t or "").split()))] for i, t, x in mixed_rows() if x == s and i not in (3, None)}
        assert max(counts) - min(counts) <= 1
    tight = mixing.mix(docs, mixing.Target(entropy=1.0, repeats=1.2, block=200)).collect()
    small = sum(r.n_tokens for r in tight if r.source == "small")
    assert small <= 1.25 * own["small"]
    again = mixing.mixed_documents(docs, target)
    assert again.columns == docs.columns and again.count() == len(got)
    assert mixing.mix(docs.where("false")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rows = toxic_table(spark, 300)
    docs = [(i, t, "en", f"s{i % 3}", len(t)) for i, t, _ in rows]
    docs += [(1000 + i, t, "en", "s0", n) for i, t, *_, n in docs[:50]]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, x) for i, _, x in rows], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    now, sizes = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.shared.stored(stage(spark, now, folder), name.replace(" ", "-"))
        assert name == "encoding" or now.columns == columns
        sizes.append(now.count())
        if name == "near copies":
            assert max(r.doc_id for r in now.collect()) < 1000
    assert sizes[0] < len(docs) and sizes[1] <= 300 and sizes[2] == sizes[3] > 0
    assert [x for x in now.columns] == ["doc_id", "ids", "decoded"]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_kept_documents_with_clashing_columns_and_shared_ids(spark):
    text = "a b c d e f g h i j k l m"
    rows = [(1, text, True, 5, 7, 0), (1, "another text with as many words in it", True, 5, 7, 1), (2, text, True, 5, 7, 2),
            (3, None, None, 1, 1, 3), (3, "", None, 1, 1, 4), (None, "n", None, 1, 1, 5), (4, text, None, 1, 1, 6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, rows int, _at int, row int")
    kept = ngram_join.kept_documents(table)
    assert kept.columns == table.columns
    found = sorted(r["row"] for r in kept.collect())
    assert found in ([0, 1, 3, 5], [0, 1, 4, 5])


def test_toxicity_keeps_every_gram(spark, monkeypatch):
    """More than 300,000 grams: the tables' evidence is that of plain models over all of them."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzäöüß"
    rows = [(k, " ".join("".join(rng.choice(letters) for _ in range(9)) for _ in range(170)) + (" zwofter" if k == 7 else ""),
             int(k % 8 == 7)) for k in range(400)]
    rows += [(500, None, 0), (501, "", 1), (502, "x" * 3000 + " abcdef", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    plain = Counter(), Counter()
    for _, text, toxic in rows:
        for word in toxicity.words(text):
            plain[1 - toxic].update(toxicity.grams(word))
    table = {g: (plain[0][g], plain[1][g]) for g in plain[0] | plain[1]}
    assert len(table) > 300_000
    model, tables = toxicity.build(table), toxicity.build_tables(
        toxicity.shared.stored(toxicity.counted(docs.selectExpr("*", "doc_id % 2 = 0 AS curve")), "grams"), 2)[1]
    for plain_values, found in ((model.ratio, tables.ratio), (model.backoff, tables.backoff)):
        got = {r[0]: r[1] for t in found.values() for r in t.collect()}
        assert got.keys() == plain_values.keys()
        assert all(math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-9) for k, v in plain_values.items())
    monkeypatch.setattr(toxicity, "PIECE", 20_000)
    got = {r.doc_id: [r[c] for c in toxicity.FEATURES] for r in toxicity.featured(docs, tables, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        found = toxicity.words(text)
        expected = toxicity.features(np.array([model.word(w) for w in found]), np.array([len(w) + 1.0 for w in found]))
        assert np.allclose(got[i], expected, rtol=1e-9, atol=1e-9), i


@pytest.mark.parametrize("letters", ["abcé", "".join(map(chr, range(0x4E00, 0x4E00 + 3000)))])
def test_grams_of_many_words(letters):
    """Both forms of the numbers, small and large alphabets, and more words than one chunk has."""
    rng = random.Random(7)
    found = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(70_000)} | {"x" * 700_000})
    made = toxicity.Grams(found)
    assert (made.halves is None) == (letters == "abcé") and len(made._chunks()) > 1
    spelled = made.spelled()
    assert len(set(spelled)) == len(spelled) and set(spelled) == {g for w in found for g in toxicity.grams(w)}
    number = {g: k for k, g in enumerate(spelled)}
    values, weights = np.arange(len(spelled)) % 97, np.array([[k % 5, 1] for k in range(len(found))])
    evidence, counts = made.evidence(values.astype(float)), Counter()
    for k in rng.sample(range(len(found)), 3000):
        assert evidence[k] == sum(values[number[g]] for g in toxicity.grams(found[k]))
    for k, w in enumerate(found):
        for g in toxicity.grams(w):
            counts[g] += k % 5
    assert made.counts(weights)[:, 0].tolist() == [counts[g] for g in spelled]
    assert toxicity.Grams([]).spelled() == [] and len(toxicity.Grams([]).evidence(np.zeros(0))) == 0


def test_no_plan_of_gram_values_joins_more_than_one_order(spark, monkeypatch):
    """A plan of all orders is written anew after each of its stages, which the driver's memory has to hold."""
    docs = spark.createDataFrame([(k, f"ab{k} cd blar{k % 7}", int(k % 3 == 0)) for k in range(60)], "doc_id long, text string, toxic int")
    tables = toxicity.build_tables(toxicity.shared.stored(toxicity.counted(docs.selectExpr("*", "doc_id % 2 = 0 AS curve")), "grams"), 2)[1]
    plans, stored = [], toxicity.shared.stored

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().analyzed().toString().count("Join ")))
        return stored(df, name)

    monkeypatch.setattr(toxicity.shared, "stored", watched)
    asked = spark.createDataFrame([(g,) for w in ("ab1", "cd", "blar3", "new") for g in toxicity.grams(w)], "gram string")
    got = {r.gram: r.value for r in toxicity.gram_values(asked, tables).collect()}
    plain = [Counter(), Counter()]
    for r in docs.collect():
        for word in toxicity.words(r.text):
            plain[1 - r.toxic].update(toxicity.grams(word))
    model = toxicity.build({g: (plain[0][g], plain[1][g]) for g in plain[0] | plain[1]})
    for word in ("ab1", "cd", "blar3", "new"):
        assert abs(sum(got[g] for g in toxicity.grams(word)) - model.word(word)) < 1e-9
    assert max(n for _, n in plans) <= 3, plans


def test_counting_takes_one_python_worker_a_task(spark):
    """However few the labels are, a shuffle parts the filter of documents from the count of their grams."""
    docs = spark.createDataFrame([(k, f"word{k % 7} of it") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 3 == 0) for k in range(50)], "doc_id long, toxic boolean").selectExpr("doc_id", "int(toxic) AS toxic")
    found = toxicity.counted(toxicity.labelled(docs, labels, list(range(5))))
    assert {r.gram: r.toxic1 + r.ordinary1 for r in found.collect()}["\x02\x02\x02\x02\x02o"] == 50
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 2 and "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
