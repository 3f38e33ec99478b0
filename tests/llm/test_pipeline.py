"""The whole pipeline against plain versions of its four stages."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from foliospark.llm import queries, toxicity


def fixture():
    rng = random.Random(11)
    words = ["the", "of", "and", *("".join(rng.choice("aeioklmnrst") for _ in range(rng.randint(3, 9))) for _ in range(900))]
    rows, labels = [], []
    for k in range(420):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        toxic = k % 6 == 0
        for _ in range(5 if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(["blargish", "zwofter", "grumpfel"])
        rows.append((k, " ".join(text), "en", f"s{k % 3 if k % 5 else 0}"))
        if k % 4:
            labels.append((k, 1, int(toxic)))
    for k in range(60):                                   # exact and near copies
        text = rows[rng.randrange(100)][1].split()
        if k % 2:
            text[rng.randrange(len(text))] = "changed"
        rows.append((1000 + k, " ".join(text), "de", "s1"))
    rows += [(2000, None, None, "s2"), (2001, "", "en", None), (2002, "", "en", "s2"), (2003, "ΣΑΣ straße ﬁ 日本語 <|endoftext|>", None, "s2")]
    return [(*r, len(r[1] or "")) for r in rows], labels


def ordinary(rows, labels):
    """Rows whose score is below 0.5 by models in memory."""
    texts, marks = {r[0]: r[1] for r in rows}, {i: x for i, _, x in labels}
    fold = {i: zlib.crc32(str(i).encode()) % toxicity.FOLDS for i in marks}

    def model(folds):
        counts = Counter(), Counter()
        for i, x in marks.items():
            if fold[i] in folds:
                for word in toxicity.words(texts[i]):
                    counts[1 - x].update(toxicity.grams(word))
        return toxicity.build({g: (counts[0][g], counts[1][g]) for g in counts[0] | counts[1]})

    def features(m, text):
        found = toxicity.words(text)
        return toxicity.features(np.array([m.word(w) for w in found]), np.array([len(w) + 1.0 for w in found]))

    learning = {k for k in range(toxicity.FOLDS) if k != toxicity.HELD_OUT}
    others, whole, curve = model(learning - {toxicity.CURVE}), model(learning), toxicity.Curve()
    sample = sorted(i for i in marks if fold[i] == toxicity.CURVE)
    toxicity.fit_curve(curve, np.array([features(others, texts[i]) for i in sample]), np.array([marks[i] for i in sample], float))
    scores = curve.score(np.array([features(whole, r[1]) for r in rows]))
    assert (np.abs(scores - 0.5) > 1e-6).all()
    return [r for r, s in zip(rows, scores, strict=True) if s < 0.5]


def one_of_each(rows):
    grams = {}
    for i, text, *_ in rows:
        found = re.findall(r"[^\W_]+", (text or "").lower())
        grams[i] = text or "", {tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))} if found else set()
    root = {i: i for i in grams}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, (text_a, x) in grams.items():
        for b, (text_b, y) in grams.items():
            if a < b and (text_a == text_b or x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return [r for r in rows if find(r[0]) == r[0]]


def mixed(rows):
    """As often as the SQL of the mixing query says (no source here is small enough to reach the limit of repeats)."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    by_id = {r[0]: r for r in rows}
    return [by_id[i] for (i,) in con.execute(f"SELECT doc_id FROM ({queries.ORACLE['op9_mixing']})").fetchall()]


def test_run_equals_plain_stages(spark, tmp_path):
    rows, labels = fixture()
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "ids", "decoded"]
    kept = ordinary(rows, labels)
    single = one_of_each(kept)
    assert len(kept) < len(rows) - 50 and len(single) < len(kept) - 20
    library, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for i, text, *_ in mixed(single):
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got.collect()) == expected


def test_stages_with_odd_tables(spark, tmp_path):
    """Nulls, clashing names and columns beyond the usual ones; then no rows and no labels at all."""
    folder = str(tmp_path)
    docs = spark.createDataFrame(
        [(1, "a b c d e f", "en", "s", 11, True, 1, b"x"), (1, "a b c d e f", "en", "s", 11, True, 2, None), (None, "x y", None, None, None, None, None, None),
         (3, None, None, "s", None, False, 3, b""), (4, "blar " * 4000, "en", "s", 20_000, True, 4, b"")],
        "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _at int, digest binary")
    spark.createDataFrame([(1, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for start in (docs, docs.where("false")):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = corpus_pipeline.shared.stored(stage(spark, now, folder), name.replace(" ", "-"))
            assert name == "encoding" or (now.columns == docs.columns and now.schema.simpleString() == docs.schema.simpleString())
            if name in ("toxicity", "near copies"):
                assert {r.doc_id for r in now.collect()} == {r.doc_id for r in start.collect()}
    assert now.count() == 0
