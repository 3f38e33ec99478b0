import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from foliospark import values
from foliospark.functions import formats
from foliospark.operators import quality, routing

REQUEST = "request_id bigint, source_mime string, target_mime string, size bigint, options map<string,string>"


@pytest.fixture(scope="module")
def registry(spark):
    return routing.builtin_registry(spark).cache()


def routed(spark, registry, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], REQUEST)
    return [(r.transformer, r.status) for r in routing.route(df, registry).orderBy("request_id").collect()]


def test_counts(spark, registry):
    assert registry.count() == 42
    assert registry.select("transformer").distinct().count() == 16
    assert registry.select("source_mime", "target_mime").distinct().count() == 38
    assert registry.select("source_mime").distinct().count() == 25
    assert registry.select("target_mime").distinct().count() == 8
    pairs = {(r.source_mime, r.target_mime): r.transformers for r in routing.ambiguous_pairs(registry).collect()}
    assert pairs == {
        (values.PDF, values.METADATA): "ai-metadata,pdf-pii-metadata", (values.PDF, values.PDF): "ocr,pdf-pii-redaction",
        (values.MARKDOWN, values.PDF): "markdown,md2doc", (values.X_MARKDOWN, values.PDF): "markdown,md2doc"}


def test_route(spark, registry):
    pdf, meta, big = values.PDF, values.METADATA, values.LIMIT_FILE
    assert routed(
        spark, registry,
        ("no/type", pdf, 1, {}), (pdf, "no/type", 1, {}), (pdf, values.DOCX, big, {}), (pdf, values.DOCX, big + 1, {}),
        (values.HTML, values.MARKDOWN, 10**12, {}), (pdf, pdf, 1, {}), (pdf, pdf, 1, {"label": "x"}),
        (pdf, pdf, 1, {"label": "x", "language": "de"}), (values.MARKDOWN, pdf, 1, {}),
        (values.MARKDOWN, pdf, 1, {"tocEnabled": "true"}), (pdf, meta, 1, {}), (pdf, "some-" + meta, 1, {"entities": "x"}),
        (values.TEXT, meta, values.LIMIT_TEXT + 1, {}), (values.TEXT, meta, 5, None),
    ) == [
        (None, "unsupported"), (None, "unsupported"), ("pdf2docx", "ok"), (None, "too_large"),
        ("html2md", "ok"), ("ocr", "ok"), ("pdf-pii-redaction", "ok"), (None, "bad_option"), ("markdown", "ok"),
        ("md2doc", "ok"), ("ai-metadata", "ok"), ("pdf-pii-metadata", "ok"), (None, "too_large"), ("ai-metadata", "ok")]


def test_unsupported_and_oversized(spark, registry):
    df = spark.createDataFrame([(1, "no/type", values.PDF, 1, {}), (2, values.PDF, values.DOCX, 10**9, {}),
                                (3, values.PDF, values.DOCX, 1, {})], REQUEST)
    assert [r.request_id for r in routing.unsupported(df, registry).collect()] == [1]
    assert [(r.request_id, r.limit_bytes) for r in routing.oversized(df, registry).collect()] == [(2, values.LIMIT_FILE)]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([values.PDF, values.TEXT, values.MARKDOWN, "x/y"]),
                          st.sampled_from([values.PDF, values.METADATA, values.DOCX]), st.integers(0, 10**8),
                          st.dictionaries(st.sampled_from(["label", "language", "tocDepth", "zz"]), st.just("1"))),
                min_size=5, max_size=30))
def test_every_request_is_kept_once(spark, registry, rows):
    out = routed(spark, registry, *rows)
    assert len(out) == len(rows)
    assert all((t is not None) == (s == "ok") for t, s in out)


def test_load_registry(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({
        "transformOptions": {"g1": [{"value": {"name": "o1", "required": False}}, {"value": {"name": "o2"}}],
                             "g2": [{"value": {"name": "o3"}}]},
        "transformers": [{"transformerName": "t", "supportedSourceAndTargetList": [
            {"sourceMediaType": "a/b", "targetMediaType": "their-metadata-extract", "maxSourceSizeBytes": 7},
            {"sourceMediaType": "a/b", "targetMediaType": "c/d"}], "transformOptions": ["g1", "g2"]}]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"transformers": [{"transformerName": "u", "supportedSourceAndTargetList": [
        {"sourceMediaType": "a/b", "targetMediaType": "c/d"}]}]}))
    rows = sorted(tuple(r) for r in routing.load_registry(spark, str(tmp_path)).collect())
    assert rows == [("t", "a/b", "c/d", None, ["o1", "o2", "o3"]),
                    ("t", "a/b", values.METADATA, 7, ["o1", "o2", "o3"]), ("u", "a/b", "c/d", None, [])]


def test_options(spark):
    rows = [
        {}, {"tocEnabled": " TRUE ", "tocDepth": " 5 ", "timeOffset": "-2", "scoreThreshold": " 0.25 "},
        {"tocEnabled": "yes", "tocDepth": "abc", "timeOffset": " ", "scoreThreshold": "", "label": "", "model": " "},
        {"tocDepth": "99999999999", "language": "fra+eng", "aiFields": ""}]
    df = spark.createDataFrame([(i, o) for i, o in enumerate(rows)], "doc_id int, options map<string,string>")
    got = [r.asDict() for r in routing.resolve_options(df).orderBy("doc_id").collect()]
    default = {name: value for name, (_t, value) in values.OPTION_DEFAULTS.items()}
    for r in got:
        r.pop("doc_id"), r.pop("options")
    assert got[0] == {**default, "warnings": ""}
    assert got[1] == {**default, "tocEnabled": True, "tocDepth": 5, "timeOffset": -2, "scoreThreshold": 0.25, "warnings": ""}
    assert got[2] == {**default, "label": "", "warnings": "scoreThreshold,tocDepth"}
    assert got[3] == {**default, "language": "fra+eng", "aiFields": "", "warnings": "tocDepth"}


def test_formats(spark):
    df = spark.createDataFrame([("video/webm", "3725"), (None, "x"), ("image/png", None), (values.MSG, "59")], "m string, n string")
    got = [tuple(r) for r in df.select(
        formats.mime_extension(F.col("m"), "whisper"), formats.mime_extension(F.col("m"), "video"),
        formats.mime_extension(F.col("m"), "image"), formats.mime_extension(F.col("m"), "mail"),
        formats.mime_extension(F.col("m"), "result"), formats.hhmmss(F.col("n"))).collect()]
    assert got == [(".audio", ".webm", ".jpg", ".eml", "bin", "01:02:05"), (".audio", ".mp4", ".jpg", ".eml", "bin", "00:00:01"),
                   (".audio", ".mp4", ".png", ".eml", "png", "00:00:01"), (".audio", ".mp4", ".jpg", ".msg", "bin", "00:00:59")]
    date = spark.sql("SELECT timestamp'2026-01-01 12:00:00' AS t UNION ALL SELECT NULL").select(formats.format_date(F.col("t")))
    assert {r[0] for r in date.collect()} == {"Thu Jan 01 12:00:00 UTC 2026", ""}


def test_conformance_matrix(spark, registry):
    matrix = quality.builtin_matrix(spark)
    assert matrix.count() == 45
    assert matrix.select("engine", "source_mime", "target_mime").distinct().count() == 41
    assert [tuple(r) for r in quality.untested_pairs(registry, matrix).collect()] == [("ai", values.PDF, values.METADATA)]


def test_conformance(spark):
    rows = [("e", values.TEXT, "ok", None, 0, '{"a":1}', values.METADATA), ("e", "s", "ok", None, 0, "{}", values.METADATA),
            ("e", "s", "ok", None, 0, "{a", values.METADATA), ("f", "s", "ok", None, 0, None, "t"),
            ("f", "s", "ok", None, 3, None, "t"), ("f", "s", "error", "boom", 3, None, "t")]
    results = spark.createDataFrame(
        rows, "engine string, source_mime string, status string, error string, out_len int, metadata_json string, target_mime string")
    checked = quality.conformance(results)
    assert sorted((r.result, r.reason or "") for r in checked.collect()) == sorted([
        ("PASS", ""), ("FAIL", "empty metadata: no properties extracted"), ("FAIL", "invalid JSON response"),
        ("FAIL", "empty response body"), ("PASS", ""), ("FAIL", "boom")])
    assert {tuple(r) for r in quality.conformance_summary(checked).collect()} == {("e", 1, 2, 3), ("f", 1, 2, 3), (None, 2, 4, 6)}
    assert quality.failures(checked).count() == 4
    stats = quality.run_stats(checked.selectExpr("engine AS transformer", "status", "out_len AS bytes_in", "1 AS bytes_out",
                                                 "cast(out_len AS double) AS seconds"))
    assert {r.transformer: (r.documents, r.failed, r.p95_seconds) for r in stats.collect()} == {"e": (3, 0, 0.0), "f": (3, 1, 3.0)}
