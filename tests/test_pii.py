import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from foliospark import values
from foliospark.functions import arrays, spans as S
from foliospark.operators import pii

PAGES = "doc_id bigint, page_no int, text string"


def find(spark, texts):
    pages = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], PAGES)
    return [tuple(r) for r in pii.detect_pii(pages).orderBy("doc_id", "entity_type", "start").collect()]


def test_spans_at_start_end_and_twice(spark):
    found = find(spark, ["a@b.co", "x a@b.co y a@b.co", "nothing", "", "10.0.0.1"])
    assert [(d, e, s, t, m) for d, _p, e, s, t, m, _x in found] == [
        (0, "EMAIL_ADDRESS", 0, 6, "a@b.co"), (1, "EMAIL_ADDRESS", 2, 8, "a@b.co"),
        (1, "EMAIL_ADDRESS", 11, 17, "a@b.co"), (4, "IP_ADDRESS", 0, 8, "10.0.0.1")]


def test_luhn(spark):
    assert [r[5] for r in find(spark, ["4111111111111111 4111111111111112"])] == ["4111111111111111"]


def test_adjacent_matches_inside_one_run(spark):
    """The second address starts where the first ends, inside the same run of characters."""
    assert [r[5] for r in find(spark, ["a@b.com.x@y.com"])] == ["a@b.com", ".x@y.com"]


def test_long_unbroken_run_is_linear(spark):
    text = "x" * 400_000 + " a@b.co"
    assert [r[5] for r in find(spark, [text])] == ["a@b.co"]


def test_many_matches_in_one_page(spark):
    found = find(spark, [" ".join(f"u{i}@example.com" for i in range(20_000))])
    assert len(found) == 20_000
    assert found[-1][4] - found[-1][3] == len(found[-1][5])


def test_no_match_across_pages(spark):
    docs = spark.createDataFrame([(1, "a@b\fc.com\fx@y.org")], "doc_id bigint, text string")
    pages = pii.split_pages(docs)
    assert [r.matched for r in pii.detect_pii(pages).collect()] == ["x@y.org"]
    assert pii.join_pages(pages).first().text == "a@b\fc.com\fx@y.org"


def test_entities_and_threshold(spark):
    pages = spark.createDataFrame([(1, 0, "a@b.co (555) 123-4567 10.0.0.1")], PAGES)
    spans = pii.detect_pii(pages)
    assert {r.entity_type for r in pii.filter_entities(spans).collect()} == {"EMAIL_ADDRESS", "PHONE_NUMBER"}
    assert {r.entity_type for r in pii.filter_entities(spans, " IP_ADDRESS , ").collect()} == {"IP_ADDRESS"}
    assert pii.filter_entities(spans, "").count() == 0
    assert {r.entity_type for r in pii.filter_score(spans, 0.7).collect()} == {"EMAIL_ADDRESS", "PHONE_NUMBER"}
    assert pii.detect_pii(pages, entities="PHONE_NUMBER", threshold=0.7).count() == 1
    assert pii.detect_pii(pages, entities="NONE").count() == 0


def test_own_recognizers(spark):
    table = spark.createDataFrame([("TICKET", r"T-[0-9]+", None, "T-", 0.4, None)], pii.RECOGNIZER_SCHEMA)
    pages = spark.createDataFrame([(1, 0, "see T-12 and a@b.co")], PAGES)
    both = pii.recognizers(spark).unionByName(table)
    assert {r.matched for r in pii.detect_pii(pages, both).collect()} == {"T-12", "a@b.co"}
    docs = pages.select("doc_id", "text")
    assert pii.redact_documents(docs, table=table, label="#").first().text == "see # and a@b.co"


def test_summary_and_metadata(spark):
    docs = spark.createDataFrame([(1, "a@b.co 10.0.0.1"), (2, "none")], "doc_id bigint, text string")
    by_spans = pii.pii_summary(docs, pii.detect_pii(pii.split_pages(docs))).orderBy("doc_id").collect()
    inline = pii.summarise_documents(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in by_spans] == [tuple(r) for r in inline] == [
        (1, True, "EMAIL_ADDRESS,IP_ADDRESS", 1.0, 0.8, 2), (2, False, "", 0.0, 0.0, 0)]
    meta = {tuple(r) for r in pii.pii_metadata(pii.summarise_documents(docs)).collect()}
    assert meta == {(1, "pii.hasPII", "true"), (1, "pii.entities", "EMAIL_ADDRESS,IP_ADDRESS"),
                    (2, "pii.hasPII", "false"), (2, "pii.entities", "")}


@pytest.mark.parametrize("places, expected", [
    ([(0, 2), (1, 4), (6, 7)], "#ef#h"),      # overlap
    ([(0, 2), (2, 4)], "#efgh"),              # touching
    ([(0, 8)], "#"), ([(1, 7), (2, 3)], "a#h"),  # whole, nested
    ([(5, 6), (0, 1)], "#bcde#gh"),           # unsorted
])
def test_redact_spans(spark, places, expected):
    pages = spark.createDataFrame([(1, 0, "abcdefgh"), (2, 0, "kept")], PAGES)
    spans = spark.createDataFrame([(1, 0, s, e) for s, e in places], "doc_id bigint, page_no int, start int, end int")
    got = {r.doc_id: r.text for r in pii.redact_spans(pages, spans, "#").collect()}
    assert got == {1: expected, 2: "kept"}


def test_redact_occurrences_hides_overlapping_strings(spark):
    pages = spark.createDataFrame([(1, 0, "x AB ab xabcd a.c abc \\Eq")], PAGES)
    spans = spark.createDataFrame([(1, 0, "ab"), (1, 0, "bcd"), (1, 0, "a.c"), (1, 0, "\\Eq")],
                                  "doc_id bigint, page_no int, matched string")
    assert pii.redact_occurrences(pages, spans, "#").first().text == "x AB # x# # #c #"
    assert pii.redact_occurrences(pages, spans, "#", ignore_case=True).first().text == "x # # x# # #c #"


def test_everywhere_within_a_page_only(spark):
    docs = spark.createDataFrame([(1, "10.0.0.1 v10.0.0.1x\f210.0.0.1y")], "doc_id bigint, text string")
    assert pii.redact_documents(docs, label="#").first().text == "# v10.0.0.1x\f210.0.0.1y"
    assert pii.redact_documents(docs, label="#", everywhere=True).first().text == "# v#x\f210.0.0.1y"


def test_row_wise_options(spark):
    docs = spark.createDataFrame([("a@b.co 10.0.0.1", "IP_ADDRESS", 0.5, "<ip>"), ("a@b.co", "EMAIL_ADDRESS", 2.0, "x")],
                                 "text string, entities string, threshold double, label string")
    out = docs.select(pii.redact_text(F.col("text"), None, F.col("entities"), F.col("threshold"), F.col("label")).alias("t"))
    assert [r.t for r in out.collect()] == ["a@b.co <ip>", "a@b.co"]


def test_names(spark):
    names = spark.createDataFrame([("Ana",), ("Ana Maria",), ("Ana Maria López",)], "name string")
    pages = spark.createDataFrame([(1, 0, "Hi Ana Maria López, Ana\nMaria"), (2, 0, ""), (3, 0, "Anamaria")], PAGES)
    got = sorted((r.doc_id, r.start, r.end, r.matched) for r in pii.detect_names(pages, names).collect())
    assert got == [(1, 3, 6, "Ana"), (1, 3, 12, "Ana Maria"), (1, 3, 18, "Ana Maria López"), (1, 20, 23, "Ana")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = pii.detect_names(pages, names)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.doc_id, r.start, r.end, r.matched) for r in joined.collect()) == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab1@.( )-4é\n", max_size=40), min_size=20, max_size=60))
def test_spans_slice_back_and_redaction_leaves_none(spark, texts):
    docs = spark.createDataFrame([(i, t + " a@b.co" * (i % 3)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    originals = {r.doc_id: r.text for r in docs.collect()}
    pages = docs.select("doc_id", F.lit(0).alias("page_no"), "text")
    for r in pii.detect_pii(pages).collect():
        assert originals[r.doc_id][r.start:r.end] == r.matched
    redacted = pii.redact_documents(docs, sep="\f", label="")
    fixed = pii.redact_spans(pages, pii.detect_pii(pages), "")
    assert {r.doc_id: r.text for r in redacted.collect()} == {r.doc_id: r.text for r in fixed.collect()}
    assert {r.doc_id: r.text for r in pii.join_pages(pii.split_pages(docs, "\n"), "\n").collect()} == originals


def test_scans_and_merge_by_brute_force(spark):
    rng = random.Random(1)
    cases = [[(s, s + rng.randint(1, 9)) for s in (rng.randint(0, 200) for _ in range(rng.randint(0, 120)))]
             for _ in range(40)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s array<struct<start:int,end:int>>")
    for r in df.select("i", "s", S.merge(F.col("s")).alias("m"), arrays.sums_before(
            F.transform("s", lambda x: x["start"])).alias("sums")).collect():
        covered = sorted({p for s, e in cases[r.i] for p in range(s, e + 1)})
        inside = {p + 0.5 for s, e in cases[r.i] for p in range(s, e)}
        expected, run = [], None
        for p in covered:
            if run is None:
                run = [p, p]
            elif p == run[1] + 1 and p - 0.5 in inside:
                run[1] = p
            else:
                expected.append(tuple(run))
                run = [p, p]
        if run:
            expected.append(tuple(run))
        assert [(x.start, x.end) for x in r.m] == expected
        assert r.sums == [sum(s for s, _ in cases[r.i][:k]) for k in range(len(cases[r.i]))]


def test_long_catalogue(spark):
    many = spark.range(300).select(F.concat(F.lit("X"), "id").alias("entity_type"), F.lit("x").alias("pattern"),
                                   F.lit(None).cast("string").alias("run"), F.lit("x").alias("needle"),
                                   F.lit(1.0).alias("score"), F.lit(None).cast("string").alias("validator"))
    found = pii.detect_pii(spark.createDataFrame([(1, 0, "x")], PAGES), many).collect()
    assert {r.entity_type for r in found} == {f"X{k}" for k in range(300)}


def test_names_of_any_length(spark):
    pages = spark.createDataFrame([(1, 0, "Seen: Maria da Silva Santos, Maria da  Silva, maria da Silva Santos."), (2, 0, ""),
                                   (3, 0, None)], "doc_id long, page_no int, text string")
    names = spark.createDataFrame([("Maria da Silva Santos",), ("Maria da Silva",), ("Maria",), ("x 1",), (None,)], "name string")
    got = sorted((r.doc_id, r.start, r.end, r.matched) for r in pii.detect_names(pages, names).collect())
    assert got == [(1, 6, 11, "Maria"), (1, 6, 20, "Maria da Silva"), (1, 6, 27, "Maria da Silva Santos"), (1, 29, 34, "Maria")]
    assert pii.detect_names(pages, names.limit(0)).count() == 0


def test_one_very_long_name_changes_nothing_for_others(spark):
    """A name of 10,000 words is found, and pages without its first words take part as before."""
    long = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(10_000))
    pages = spark.createDataFrame([(1, 0, f"x {long}! {long.rsplit(' ', 1)[0]}"), (2, 0, "Ana Maria López Santos Cruz, Ana Maria"), (3, 0, "wa wb wc")],
                                  "doc_id long, page_no int, text string")
    names = [("Ana Maria",), ("Ana Maria López Santos Cruz",), ("Ana Maria López Santos",), ("López Santos Cruz Ana Maria",)]
    own = [(2, 0, 9), (2, 0, 22), (2, 0, 27), (2, 29, 38)]

    def found(some):
        return sorted((r.doc_id, r.start, r.end) for r in pii.detect_names(pages, spark.createDataFrame(some, "name string")).collect())

    assert found(names) == own
    assert found([*names, (long,)]) == [(1, 2, 2 + len(long)), *own]
    short = pii.detect_names(pages, spark.createDataFrame([("Ana Maria",)], "name string"))
    assert "text#" not in "".join(line for line in short._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line)


def test_rows_without_a_key_pass_by(spark):
    from foliospark.operators.tables import split_by_keys

    rows = spark.range(5000).selectExpr("id", "IF(id % 7 = 0, NULL, id % 50) AS part", "repeat('x', 10) AS text")
    keys = spark.range(40).selectExpr("id * 3 AS id", "(id * 3) % 50 AS part")
    clear, met = split_by_keys(rows, keys, ["id", "part"])
    assert clear.columns == met.columns == rows.columns and clear.count() + met.count() == 5000
    wanted = {k * 3 for k in range(40)} - {k * 3 for k in range(40) if k * 3 % 7 == 0}
    got = {r.id for r in met.collect()}
    assert wanted <= got and len(got - wanted) <= 2
    assert "Exchange hashpartitioning(id" not in clear._jdf.queryExecution().executedPlan().toString()
    empty = split_by_keys(rows, keys.where("false"), ["id", "part"])
    assert (empty[0].count(), empty[1].count()) == (5000, 0)


def test_words_that_begin_no_name_are_not_shuffled(spark):
    pages = spark.range(200).selectExpr("id AS doc_id", "0 AS page_no", "concat(repeat('so many words ', 30), 'Ana Maria ', id) AS text")
    names = spark.createDataFrame([("Ana Maria",), ("Ana",), ("Maria López",)], "name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobGroup("names", "names")
    try:
        got = pii.detect_names(pages, names).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.doc_id, r.start, r.matched) for r in got) == sorted((i, 420, n) for i in range(200) for n in ("Ana", "Ana Maria"))
    tracker, store = spark.sparkContext.statusTracker(), spark._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup("names") for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)}
    assert 0 < sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages) < 2_000         # of 18,400 words
