import json
import math
import time

from pyspark.sql import functions as F

from foliospark import values
from foliospark.functions.text import truncate_text
from foliospark.operators import describe

DOCS = "doc_id int, text string"


def test_fields(spark):
    df = spark.createDataFrame([(None,), ("title,description,tags,language",), (" tags , nope,title,tags",), ("",), ("x, y",)], "v string")
    got = [(r[0], r[1]) for r in df.select(describe.select_fields(F.col("v")), describe.unknown_fields(F.col("v"))).collect()]
    assert got == [(values.AI_FIELDS, ""), (values.AI_FIELDS, ""), (["tags", "title"], "nope"), ([], ""), ([], "x,y")]


def test_requests_hold_valid_json(spark):
    text = 'quote " back \\ tab \t newline \n bell \x07 é' + "x" * 5000
    docs = spark.createDataFrame([(1, text)], DOCS)
    rows = describe.build_requests(docs, F.lit("title,language"), "m").collect()
    assert [r.field for r in rows] == ["title", "language"]
    body = json.loads(rows[0].body)
    assert body["messages"][1] == {"role": "user", "content": text[:4000]}
    assert (body["model"], body["temperature"], body["max_tokens"]) == ("m", 0.3, 500)
    assert docs.select(F.length(truncate_text(F.col("text")))).first()[0] == 4000


def test_model_round_trip(spark):
    docs = spark.createDataFrame([(1, "good"), (2, "fail"), (3, "raise"), (4, "odd"), (5, "flaky")], DOCS)

    def make():
        import json
        seen = []

        def call(body):
            sent = json.loads(body)
            text, system = sent["messages"][1]["content"], sent["messages"][0]["content"]
            seen.append(text)
            if text == "fail":
                return 500, "down"
            if text == "raise":
                raise RuntimeError("no route")
            if text == "odd":
                return 200, '{"choices": []}'
            if text == "flaky" and seen.count(text) == 1:
                return 503, "later"
            answer = " EN " if "639" in system else ' say "hi"\nto \\ all '
            return 200, json.dumps({"content": "decoy", "choices": [{"message": {"content": answer}}]})
        return call

    requests = describe.build_requests(docs, F.lit("title,language"))
    parsed = describe.parse_responses(describe.call_model(requests, make, parallel=2, retries=1)).cache()
    status = {(r.doc_id, r.field): (r.status, r.error) for r in parsed.collect()}
    assert status[(1, "title")] == ("ok", None) and status[(5, "title")][0] == "ok"
    assert status[(2, "title")] == ("error", "HTTP 500")
    assert status[(3, "title")] == ("error", "RuntimeError: no route")
    assert status[(4, "title")] == ("error", "response without content")
    wide = {r.doc_id: r for r in describe.pivot_fields(parsed).collect()}
    assert wide[1].ai_title == 'say "hi"\nto \\ all' and wide[1].ai_locale == "en"
    assert wide[1].ai_taggable is None and wide[2].ai_title is None


def test_contract_and_tags(spark):
    rows = [(1, "one two three four five", "p", "a, b ,,C,a,d,e", "en"), (2, "short", "p\n\nq", "a", "eng"), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id int, title string, description string, tags string, language string")
    got = {r.doc_id: tuple(r)[1:] for r in describe.check_ai_contract(df).collect()}
    assert got == {1: (True, True, True, True), 2: (False, False, False, False), 3: (False, False, False, False)}
    assert [(r.doc_id, r.tag) for r in describe.explode_tags(df).collect()] == [
        (1, "a"), (1, "b"), (1, "c"), (1, "d"), (1, "e"), (2, "a")]


def test_offline_title_language(spark):
    docs = spark.createDataFrame([(1, "  The  cat\nand the dog of \t it all now here and there"), (2, "der und die"), (3, "xyz 12"), (4, ""),
                                  (5, "the der")], DOCS)
    titles = {r.doc_id: r.title for r in describe.offline_title(docs).collect()}
    assert titles[1] == "The cat and the dog of it all now here" and titles[4] == ""
    langs = {r.doc_id: (r.language, r.hits) for r in describe.offline_language(docs).collect()}
    assert langs == {1: ("en", 5), 2: ("de", 3), 3: (None, 0), 4: (None, 0), 5: ("de", 1)}


def test_tfidf_by_brute_force(spark, monkeypatch):
    """Hot and cold words give the same scores whatever the split between them."""
    texts = {i: " ".join(f"word{'abcdefghij'[j % (i % 7 + 2)]}" for j in range(i + 3)) + f". Rare{'xyzuvw'[i % 6]}word end here"
             for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    words = {i: [w for w in "".join(c if c.isalpha() else " " for c in t.lower()).split() if len(w) >= 4] for i, t in texts.items()}
    df = {}
    for ws in words.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    expected = {(i, w): round(ws.count(w) * math.log((len(texts) + 1) / (df[w] + 1)), 6) for i, ws in words.items() for w in ws}
    for hot in (1, 20, 10_000):
        monkeypatch.setattr(describe, "HOT_WORDS", hot)
        got = {(r.doc_id, r.word): r.score for r in describe.word_scores(docs).collect()}
        assert got.keys() == expected.keys()
        assert all(abs(got[k] - expected[k]) < 1e-5 for k in got)
    tags = {}
    for r in describe.offline_tags(docs, 3).collect():
        tags.setdefault(r.doc_id, []).append((r.rank, r.word))
    for i in texts:
        best = sorted(set(words[i]), key=lambda w: (-expected[(i, w)], w))[:3]
        assert [w for _, w in sorted(tags[i])] == best


def test_description_keeps_text_order(spark):
    text = "common words here. unusual zebra crossing! common words here? another quixotic sentence. common words here"
    docs = spark.createDataFrame([(1, text)] + [(i, "common words here. another common sentence") for i in range(2, 12)], DOCS)
    got = {r.doc_id: r.description for r in describe.offline_description(docs, 2).collect()}
    assert got[1] == "unusual zebra crossing. another quixotic sentence"
    assert len(got) == 11


def test_calls_run_side_by_side_in_order(spark):
    """32 calls of 50 ms in one task take well below their sum, and answers stay with their requests."""
    def make():
        def call(body):
            import time
            time.sleep(0.05)
            return 200, "re: " + body
        return call

    rows = spark.range(32).selectExpr("id AS doc_id", "'f' AS field", "concat('b', id) AS body").coalesce(1)
    describe.call_model(rows, make, concurrency=16).collect()           # workers are up
    started = time.monotonic()
    got = describe.call_model(rows, make, concurrency=16).collect()
    assert time.monotonic() - started < 1.2
    assert [(r.doc_id, r.response) for r in got] == [(k, f"re: b{k}") for k in range(32)]


def test_failing_calls_come_again_after_a_pause(spark):
    def make():
        seen = {}

        def call(body):
            import time
            times = seen.setdefault(body, [])
            times.append(time.monotonic())
            if body == "never":
                raise OSError("down")
            if len(times) < 3:
                return 503, "busy"
            return 200, str(min(b - a for a, b in zip(times, times[1:], strict=False)) >= 0.01)
        return call

    rows = spark.createDataFrame([(1, "f", "soon"), (2, "f", "never")], "doc_id long, field string, body string").coalesce(1)
    got = {r.doc_id: r for r in describe.call_model(rows, make, retries=2, concurrency=2, pause=0.02).collect()}
    assert (got[1].status_code, got[1].response, got[1].error) == (200, "True", None)
    assert got[2].error == "OSError: down" and got[2].status_code is None
