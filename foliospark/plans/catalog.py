"""Every operator as a query over the given tables.

Inputs that the tables do not hold (requests, e-mails, XML, workbooks,
Markdown, results) are derived from them by expressions, so that each query
grows with its tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliospark import values
from foliospark.api import Toolbox, register_pii_spans
from foliospark.functions import formats, text as T
from foliospark.operators import convert, describe, metadata, pii, quality, routing, tools
from foliospark.plans import transforms
from foliospark.session import shared_dir
from foliospark.sources import files, parsers
from foliospark.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# --- derived inputs -------------------------------------------------------------

SOURCES = [*dict.fromkeys(s for *_, groups in values.TRANSFORMERS for ss, _t, _l in groups for s in ss),
           "application/unknown"]
TARGETS = [*dict.fromkeys(t for *_, groups in values.TRANSFORMERS for _s, ts, _l in groups for t in ts)]

# Requested options by doc_id modulo 7.
OPTION_SETS = [
    {}, {"language": "de"}, {"tocEnabled": " TRUE ", "tocDepth": "x"}, {"aiFields": "tags, nope,title"},
    {"timeOffset": "3725"}, {"scoreThreshold": "0.7", "label": "[X]"}, {},
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work on texts."""
    return table(spark, sf, name).select(*columns)


def pick(items: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in items]), (index + 1).cast("int"))


def option_map(index: Column) -> Column:
    chosen = None
    for i, options in enumerate(OPTION_SETS):
        literal = F.create_map(*[F.lit(x) for pair in options.items() for x in pair]) if options else \
            F.from_json(F.lit("{}"), "map<string,string>")
        chosen = F.when(index == i, literal) if chosen is None else chosen.when(index == i, literal)
    return chosen


def requests(spark: SparkSession, sf: str) -> DataFrame:
    n = len(SOURCES)
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("request_id"),
        pick(SOURCES, F.col("doc_id") % n).alias("source_mime"),
        pick(TARGETS, F.floor(F.col("doc_id") / n) % len(TARGETS)).alias("target_mime"),
        (F.col("n_chars") * 4000).alias("size"),
        option_map(F.col("doc_id") % 7).alias("options"))


def doc_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pii.split_pages(texts(spark, sf, "documents", "doc_id", "text"), "\n")


def markdown_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with mark-up added by line number."""
    docs = texts(spark, sf, "documents", "doc_id", "text")

    def mark(line: Column, i: Column) -> Column:
        k = (i + F.length(line)) % 12
        return (F.when(k == 0, F.concat(F.lit("# "), line)).when(k == 1, F.concat(F.lit("## "), line))
                 .when(k == 2, F.concat(F.lit("### "), line, F.lit(" ##"))).when(k.isin(3, 4), F.concat(F.lit("- "), line))
                 .when(k == 5, F.concat(F.lit("1. "), line)).when(k == 6, F.lit("```"))
                 .when(k == 7, F.lit("---")).when(k == 8, F.lit(""))
                 .when(k == 9, F.concat(F.lit("**bold** "), line, F.lit(" [link](http://x.org/a) & `c*d`")))
                 .otherwise(line))

    return docs.select("doc_id", F.array_join(F.transform(F.split("text", "\n"), mark), "\n").alias("markdown"))


def emails(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as RFC 822 messages; every third conversation as multipart."""
    turn = texts(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    head = F.format_string(
        "From: %s <%s@example.com>\nTo: a@example.com, b@example.com\nSubject: Conversation %d turn %d\n"
        "Date: Thu, 01 Jan 2026 12:00:%02d +0200\nMIME-Version: 1.0\n",
        "role", "role", "conv_id", "turn", F.col("turn") % 60)
    part = "Content-Type: text/%s; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"
    single = F.concat(head, F.lit(part % "plain"), "text")
    multi = F.concat(
        head, F.lit('Content-Type: multipart/alternative; boundary="=_b"\n\n--=_b\n' + part % "html"), F.lit("<p>"),
        F.col("text"), F.lit("</p>\n--=_b\n" + part % "plain"), F.col("text"), F.lit("\n--=_b--\n"))
    return turn.select(_turn_id(), F.encode(F.when(F.col("conv_id") % 3 == 1, multi).otherwise(single), "UTF-8")
                       .alias("content"))


def _turn_id() -> Column:
    return F.concat_ws("-", "conv_id", "turn").alias("doc_id")


def xml_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as XML; every tenth conversation has a DOCTYPE."""
    turn = texts(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    escaped = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    start = F.when(F.col("conv_id") % 10 == 0, "<!DOCTYPE turn>").otherwise("")
    return turn.select(_turn_id(), F.concat(
        start, F.lit('<turn xmlns:d="urn:d"><d:title> '), F.col("role"), F.lit("</d:title><author>first</author>"),
        F.lit("<author>"), F.col("role"), F.lit("</author><author> \n</author><keywords/><body><p>"), escaped,
        F.lit("</p><p>end</p></body></turn>")).alias("xml"))


def workbooks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as minimal workbooks whose properties hold the text."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile
        from xml.sax.saxutils import escape

        for batch in batches:
            made = []
            for text, lang, source in zip(batch["text"], batch["lang"], batch["source"]):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("xl/workbook.xml", "<workbook/>")
                    archive.writestr("docProps/core.xml", (
                        '<p:coreProperties xmlns:p="urn:p" xmlns:dc="urn:dc">'
                        f"<dc:title> </dc:title><dc:creator>{escape(source)}</dc:creator>"
                        f"<dc:description>{escape(text)}</dc:description><p:keywords> {escape(lang)} </p:keywords>"
                        "<p:revision>7</p:revision></p:coreProperties>").encode("utf-8"))
                made.append(out.getvalue())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "content": made})

    docs = texts(spark, sf, "documents", "doc_id", "text", "lang", "source")
    return docs.mapInPandas(build, "doc_id bigint, content binary")


def page_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Raw metadata of the web pages, some of it blank or padded."""
    html, url = F.col("html"), F.col("url")
    item = metadata.metadata_column
    return table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.lit("xml").alias("extractor"), F.inline(
        F.array(
            item(F.concat(F.lit("\t"), F.regexp_extract(html, "<title>([^<]*)</title>", 1), F.lit(" \n")), "title"),
            item(F.regexp_extract(url, "^https?://([^/]*)", 1), "author"),
            item(F.when(F.col("page_id") % 3 > 0, F.regexp_extract(html, "<h1>([^<]*)</h1>", 1)), "description"),
            item(F.when(F.col("page_id") % 2 > 0, F.regexp_extract(html, 'lang="([a-z]+)"', 1)).otherwise(F.lit(" \t ")),
                 "subject"),
            item(F.regexp_extract(url, r"\?(.*)$", 1), "keywords"),
            item(F.length(html), "length"))))


def event_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties (JSON) as raw metadata."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("doc_id"), F.lit("excel").alias("extractor"),
        F.inline(F.array(
            metadata.metadata_column(F.get_json_object("props", "$.k"), "excel.keywords"),
            metadata.metadata_column("event_type", "excel.title"),
            metadata.metadata_column(F.when(F.col("event_id") % 4 == 0, F.col("user_id")), "excel.subject"),
            metadata.metadata_column("value", "excel.revision"))))


def registry_rows(spark: SparkSession) -> DataFrame:
    rows = [(i, engine, name, s, t) for i, (engine, name, s, t) in enumerate(registry_list())]
    return spark.createDataFrame(rows, "slot bigint, engine string, transformer string, source_mime string, target_mime string")


def registry_list() -> list[tuple[str, str, str, str]]:
    return [(engine, name, s, t) for name, engine, _o, groups in values.TRANSFORMERS
            for ss, ts, _l in groups for s in ss for t in ts]


def results(spark: SparkSession, sf: str) -> DataFrame:
    """One transform result per document, with failures of every kind."""
    n = len(registry_list())
    slots = F.broadcast(registry_rows(spark))  # as many rows as the registry has pairs
    d = F.col("doc_id")
    return table(spark, sf, "documents").withColumn("slot", d % n).join(slots, "slot").select(
        "doc_id", "engine", "transformer", "source_mime", "target_mime",
        F.when(d % 11 == 0, "error").otherwise("ok").alias("status"),
        F.when(d % 11 == 0, F.concat(F.lit("exit code "), (d % 3).cast("string"))).alias("error"),
        F.when(d % 13 == 0, F.lit(0)).otherwise(F.col("n_chars")).cast("bigint").alias("out_len"),
        F.when(d % 5 == 0, "{}").when(d % 7 == 0, "no json")
         .otherwise(F.concat(F.lit('{"cm:title":"'), F.col("lang"), F.lit('"}'))).alias("metadata_json"),
        (F.col("n_chars") * 3).alias("bytes_in"), F.col("n_chars").alias("bytes_out"),
        (F.col("n_chars") / 1000).alias("seconds"))


def parsed_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as if a model had answered for every field."""
    first = F.split(T.squeeze(F.col("text")), " ")
    return texts(spark, sf, "documents", "doc_id", "text", "lang").select("doc_id", F.inline(F.array(
        *[F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in (
            ("title", F.array_join(F.slice(first, F.lit(1), (F.col("doc_id") % 12 + 1).cast("int")), " ")),
            ("description", F.col("text")),
            ("tags", F.array_join(F.slice(first, F.lit(2), (F.col("doc_id") % 13).cast("int")), " , ")),
            ("language", F.concat(F.lit(" "), F.upper("lang"), F.when(F.col("doc_id") % 9 == 0, "x").otherwise("")))
        )])))


# --- queries ----------------------------------------------------------------------


def s1_read_documents(spark, sf):
    folder = shared_dir(spark) + "/s1-" + _unique()
    docs = table(spark, sf, "documents").select(
        "doc_id", F.lit(values.TEXT).alias("target_mime"), F.encode("text", "UTF-8").alias("content"))
    files.export_files(docs, folder).write.format("noop").mode("overwrite").save()
    return files.read_documents(spark, folder).select(
        F.regexp_extract("doc_id", r"([^/]+)$", 1).alias("file_name"), "source_mime", "size",
        F.md5("content").alias("digest"))


def _unique() -> str:
    import uuid
    return uuid.uuid4().hex[:12]


def s2_decode_text(spark, sf):
    docs = table(spark, sf, "documents")
    bad = F.when(F.col("doc_id") % 3 == 0, F.lit(b"\xff")).otherwise(F.lit(b""))
    mime = F.when(F.col("doc_id") % 10 == 0, values.PDF).otherwise(values.TEXT)
    return files.decode_text(docs.select("doc_id", mime.alias("source_mime"),
                                         F.concat(F.encode("text", "UTF-8"), bad).alias("content")))


def s3_parse_eml(spark, sf):
    return parsers.parse_eml(emails(spark, sf))


def s4_parse_xml(spark, sf):
    return parsers.parse_xml(xml_docs(spark, sf)).select("doc_id", "pos", "key", "value", "status")


def s5_read_xlsx_properties(spark, sf):
    return parsers.read_xlsx_properties(workbooks(spark, sf)).select("doc_id", "key", "value", "status")


def s6_write_results(spark, sf):
    folder = shared_dir(spark) + "/s6-" + _unique()
    out = table(spark, sf, "documents").select(
        "doc_id", pick(TARGETS, F.col("doc_id") % len(TARGETS)).alias("target_mime"), F.col("text").alias("out_text"))
    files.write_results(out, folder)
    return spark.read.parquet(folder).select("doc_id", "target_mime", "out_text", "file_name", "target")


def s7_metadata_json(spark, sf):
    return metadata.metadata_json(m6_resolve_collisions(spark, sf))


def s7_one_row_per_document(spark, sf):
    """XML files of which most hold no mapped key, or nothing at all: each has a result."""
    content = (F.when(F.col("turn") % 3 == 0, F.concat(F.lit("<turn><title>"), "role", F.lit("</title></turn>")))
                .when(F.col("turn") % 3 == 1, "<turn><price>3</price></turn>").otherwise("<turn/>"))
    docs = table(spark, sf, "conversations").select(_turn_id(), F.encode(content, "UTF-8").alias("content"))
    return transforms.xmlextract(docs).select("doc_id", "status", T.decode_utf8(F.col("content")).alias("metadata_json"))


def r1_registry(spark, sf):
    asked = requests(spark, sf).groupBy("source_mime", "target_mime").agg(F.count("*").alias("requests"))
    return asked.join(routing.builtin_registry(spark), ["source_mime", "target_mime"]).select(
        "transformer", "source_mime", "target_mime", "max_bytes",
        F.array_join(F.array_sort("options"), ",").alias("options"), "requests")


def _registry_files(spark: SparkSession, sf: str, other: int) -> DataFrame:
    """Registry files made from the events, one for each type and tenth of the users, as ``load_registry`` reads them."""
    root = shared_dir(spark) + "/r-" + _unique()
    events = table(spark, sf, "events").where(F.col("user_id") % 2 == other)
    pairs = events.groupBy("event_type", (F.col("user_id") % 10).alias("part"), (F.col("user_id") % 3).alias("s"), (F.col("user_id") % 7).alias("t")).agg(
        F.max("event_id").alias("most"))
    pair = F.struct(F.format_string("x/s%d", "s").alias("sourceMediaType"),
                    F.when(F.col("t") == 0, "own-metadata-extract").otherwise(F.format_string("y/t%d", "t")).alias("targetMediaType"),
                    F.when(F.col("most") % 5 > 0, F.col("most")).alias("maxSourceSizeBytes"))

    def option(name: Column) -> Column:
        return F.struct(F.struct(name.alias("name"), F.lit(False).alias("required")).alias("value"))

    config = pairs.groupBy("event_type", "part").agg(F.collect_list(pair).alias("pairs")).select(
        F.concat_ws("-", "event_type", "part").alias("doc_id"), F.lit(values.TEXT).alias("target_mime"), F.lit("ok").alias("status"),
        F.encode(F.to_json(F.struct(
            F.struct(F.array(option(F.col("event_type")), option(F.lit("all"))).alias("own"), F.array(option(F.lit("label"))).alias("more")).alias("transformOptions"),
            F.array(F.struct(F.concat_ws("-", "event_type", "part").alias("transformerName"), F.col("pairs").alias("supportedSourceAndTargetList"),
                             F.when(F.col("part") % 3 == 0, F.array(F.lit("own"), F.lit("more"), F.lit("none")))
                             .when(F.col("part") % 3 == 1, F.array(F.lit("more"))).alias("transformOptions"))).alias("transformers"))), "UTF-8").alias("content"))
    files.export_files(config, f"{root}/registry").write.format("noop").mode("overwrite").save()
    return routing.load_registry(spark, f"{root}/registry/*")


def r1_load_registry(spark, sf):
    return _registry_files(spark, sf, 0).withColumn("options", F.array_join("options", ","))


def r2_merge_registries(spark, sf):
    """Pairs that several transformers serve, of two folders of registry files and the built-in registry."""
    return routing.ambiguous_pairs(routing.merge_registries(
        _registry_files(spark, sf, 0), _registry_files(spark, sf, 1), routing.builtin_registry(spark)))


def r2_ambiguous_pairs(spark, sf):
    asked = requests(spark, sf).groupBy("source_mime", "target_mime").agg(F.count("*").alias("requests"))
    return routing.ambiguous_pairs(routing.builtin_registry(spark)).join(asked, ["source_mime", "target_mime"])


def r3_route(spark, sf):
    return routing.route(requests(spark, sf), routing.builtin_registry(spark)).select(
        "request_id", "source_mime", "target_mime", "size", "transformer", "status")


def r4_unsupported(spark, sf):
    return routing.unsupported(requests(spark, sf), routing.builtin_registry(spark)).drop("options")


def r5_oversized(spark, sf):
    return routing.oversized(requests(spark, sf), routing.builtin_registry(spark)).drop("options")


def r6_resolve_options(spark, sf):
    return routing.resolve_options(requests(spark, sf)).drop("options", "source_mime", "target_mime", "size")


def r7_mime_extension(spark, sf):
    return requests(spark, sf).select(
        "request_id",
        *[formats.mime_extension(F.col("source_mime"), f).alias(f) for f in ("whisper", "video", "image", "mail")],
        formats.mime_extension(F.col("target_mime"), "result").alias("result"))


def r8_queue_of(spark, sf):
    routed = routing.route(requests(spark, sf), routing.builtin_registry(spark)).filter("status = 'ok'")
    return routed.groupBy(formats.queue_of(F.col("transformer")).alias("queue")).agg(F.count("*").alias("requests"))


def p1_recognizers(spark, sf):
    found = p3_detect_pii(spark, sf).groupBy("entity_type").agg(F.count("*").alias("found"))
    return pii.recognizers(spark).join(found, "entity_type", "left").select(
        "entity_type", "pattern", "score", F.coalesce("validator", F.lit("")).alias("validator"),
        F.coalesce("found", F.lit(0)).alias("found"))


def p2_split_pages(spark, sf):
    return doc_pages(spark, sf)


def p3_detect_pii(spark, sf):
    return pii.detect_pii(doc_pages(spark, sf))


def p4_filter_entities(spark, sf):
    return pii.filter_entities(p3_detect_pii(spark, sf), " PERSON, PHONE_NUMBER ,EMAIL_ADDRESS")


def p5_filter_score(spark, sf):
    return pii.filter_score(p3_detect_pii(spark, sf), 0.7)


def p6_pii_summary(spark, sf):
    return pii.pii_summary(table(spark, sf, "documents"), p3_detect_pii(spark, sf)).withColumn(
        "scoreAvg", F.round("scoreAvg", 6))


def p6_pii_summary_inline(spark, sf):
    return pii.summarise_documents(texts(spark, sf, "documents", "doc_id", "text"), "\n").withColumn("scoreAvg", F.round("scoreAvg", 6))


def p7_pii_metadata(spark, sf):
    return pii.pii_metadata(pii.summarise_documents(texts(spark, sf, "documents", "doc_id", "text"), "\n"))


def _overlapping(spans: DataFrame) -> DataFrame:
    """Spans plus wider copies of some, so that overlaps have to be merged."""
    wider = spans.filter("entity_type = 'IP_ADDRESS'").withColumn("start", F.greatest(F.col("start") - 3, F.lit(0)))
    return spans.unionByName(wider)


def p8_redact_spans(spark, sf):
    return pii.redact_spans(doc_pages(spark, sf), _overlapping(p3_detect_pii(spark, sf)))


def p8_redact_documents(spark, sf):
    return pii.redact_documents(texts(spark, sf, "documents", "doc_id", "text"), "\n")


def p9_redact_occurrences(spark, sf):
    """Here the page is the whole document: a string found on any line is hidden on all."""
    docs = table(spark, sf, "documents").select("doc_id", F.lit(0).alias("page_no"), "text")
    found = p3_detect_pii(spark, sf).withColumn("page_no", F.lit(0))
    return pii.redact_occurrences(docs, found)


def p9_redact_documents_everywhere(spark, sf):
    """The same within each line, inside the row."""
    return pii.redact_documents(texts(spark, sf, "documents", "doc_id", "text"), "\n", everywhere=True)


def p10_join_pages(spark, sf):
    return pii.join_pages(doc_pages(spark, sf), "\n")


def p11_detect_names(spark, sf):
    names = table(spark, sf, "conversations").select(F.inline(F.array(*[
        F.struct(F.regexp_extract("text", p, 1).alias("name"))
        for p in (r"^(\p{L}+ \p{L}+)", r"^(\p{L}+)")]))).filter("name != ''")
    return pii.detect_names(doc_pages(spark, sf), names)


def a1_select_fields(spark, sf):
    csv = F.when(F.col("doc_id") % 6 > 0, F.concat_ws(
        " ,", F.when(F.col("doc_id") % 2 == 0, "tags"), F.col("lang"), F.when(F.col("doc_id") % 3 == 0, "title"),
        F.lit(""), F.when(F.col("doc_id") % 5 == 0, "tags"), F.when(F.col("doc_id") % 4 == 0, "language")))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(describe.select_fields(csv), ",").alias("fields"),
        F.coalesce(describe.unknown_fields(csv), F.lit("")).alias("unknown"))


def a2_truncate_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.truncate_text(F.col("text")).alias("text"))


def a3_build_requests(spark, sf):
    return describe.build_requests(table(spark, sf, "documents"))


def stand_in_model():
    """A stand-in for a model client: answers with the length of the text it was sent."""
    def make_caller():
        import json

        def call(body):
            text = json.loads(body)["messages"][1]["content"]
            if len(text) % 10 == 7:
                return 500, "busy"
            return 200, json.dumps({"choices": [{"message": {"content": f' "{len(text)}" chars\n'}}]})
        return call
    return make_caller


def a4_call_model(spark, sf):
    answers = describe.call_model(describe.build_requests(table(spark, sf, "documents")), stand_in_model())
    return answers.select("doc_id", "field", "status_code", "error")


def a5_parse_responses(spark, sf):
    return describe.parse_responses(
        describe.call_model(describe.build_requests(table(spark, sf, "documents")), stand_in_model()))


def a6_pivot_fields(spark, sf):
    return describe.pivot_fields(parsed_fields(spark, sf))


def a7_explode_tags(spark, sf):
    return describe.explode_tags(parsed_fields(spark, sf).filter("field = 'tags'").withColumnRenamed("value", "tags"))


def a8_check_ai_contract(spark, sf):
    wide = describe.pivot_fields(parsed_fields(spark, sf)).toDF("doc_id", *values.AI_FIELDS)
    return describe.check_ai_contract(wide)


def a9_offline_title(spark, sf):
    return describe.offline_title(texts(spark, sf, "documents", "doc_id", "text"))


def a10_offline_tags(spark, sf):
    return describe.offline_tags(texts(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id", "word", "tf", "score", "rank")


def a11_offline_language(spark, sf):
    return describe.offline_language(texts(spark, sf, "documents", "doc_id", "text"))


def a12_offline_description(spark, sf):
    return describe.offline_description(texts(spark, sf, "documents", "doc_id", "text"))


def m1_xml_top_level(spark, sf):
    rows = parsers.parse_xml(xml_docs(spark, sf))
    return metadata.last_of_each_key(rows.filter("status = 'ok'"))


def m2_guard_doctype(spark, sf):
    return metadata.guard_doctype(xml_docs(spark, sf)).select("doc_id", "status", "error")


def m3_xlsx_metadata(spark, sf):
    return metadata.xlsx_metadata(parsers.read_xlsx_properties(workbooks(spark, sf)))


def m4_put_if_not_blank(spark, sf):
    return metadata.put_if_not_blank(page_metadata(spark, sf))


def m5_map_metadata(spark, sf):
    mapping, _ = metadata.builtin_mapping(spark)
    meta = page_metadata(spark, sf).unionByName(event_metadata(spark, sf))
    return metadata.map_metadata(metadata.put_if_not_blank(meta), mapping)


def m6_resolve_collisions(spark, sf):
    mapping, _ = metadata.builtin_mapping(spark)
    return metadata.resolve_collisions(metadata.map_metadata(m4_put_if_not_blank(spark, sf), mapping))


def m6_resolve_collisions_concat(spark, sf):
    mapping, _ = metadata.builtin_mapping(spark)
    return metadata.resolve_collisions(metadata.map_metadata(m4_put_if_not_blank(spark, sf), mapping), "concat", " | ")


def m7_expand_qname(spark, sf):
    _, ns = metadata.builtin_mapping(spark)
    rows = m6_resolve_collisions(spark, sf)
    odd = F.when(F.col("doc_id") % 4 == 0, F.regexp_replace("property", "^cm:", "zz:")).otherwise(F.col("property"))
    return metadata.expand_qname(rows.withColumn("property", odd), ns)


def m8_merge_metadata(spark, sf):
    summary = pii.summarise_documents(texts(spark, sf, "documents", "doc_id", "text"), "\n")
    title = describe.offline_title(texts(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id", F.lit("ai.title").alias("key"), F.col("title").alias("value"))
    mapping, _ = metadata.builtin_mapping(spark)
    merged = metadata.merge_metadata(pii=pii.pii_metadata(summary), ai=title)
    return metadata.resolve_collisions(metadata.map_metadata(merged, mapping))


def m9_load_mapping(spark, sf):
    """Property lines kept in a column: one text per event type."""
    texts = table(spark, sf, "events").groupBy("event_type", (F.col("user_id") % 50).alias("part")).agg(
        F.min("event_id").alias("least")).select(
        F.concat_ws("-", "event_type", "part").alias("extractor"),
        F.format_string("# %s\nnamespace.prefix.ev=urn:%s\n\nraw.%d = ev:p%d\nlast=ev:last\n",
                        "event_type", "event_type", "least", "least").alias("text"))
    mapping, ns = metadata.parse_mapping(texts)
    return mapping.join(ns.groupBy("prefix").agg(F.count("*").alias("uris")), "prefix")


def m9_mapping_files(spark, sf):
    """The same kind of lines as property files, one a part, read with ``load_mapping``."""
    root = shared_dir(spark) + "/m9-" + _unique()
    texts = table(spark, sf, "events").groupBy("event_type", (F.col("user_id") % 20).alias("part")).agg(F.min("event_id").alias("least")).select(
        F.concat_ws("-", "event_type", "part").alias("doc_id"), F.lit(values.TEXT).alias("target_mime"), F.lit("ok").alias("status"),
        F.encode(F.format_string("! %s\r\nnamespace.prefix.f%d=http://f.org/%s\n raw.%d = f%d:p\n\nlast=f%d:last",
                                 "event_type", "part", "event_type", "least", "part", "part"), "UTF-8").alias("content"))
    files.export_files(texts, f"{root}/properties").write.format("noop").mode("overwrite").save()
    mapping, ns = metadata.load_mapping(spark, f"{root}/properties/*")
    return mapping.join(ns.groupBy("prefix").agg(F.array_join(F.array_sort(F.collect_set("uri")), ",").alias("uris")), "prefix")


def c1_html_text(spark, sf):
    return convert.html_text(texts(spark, sf, "pages", "page_id", "html"))


def c2_html_to_markdown(spark, sf):
    return convert.html_to_markdown(texts(spark, sf, "pages", "page_id", "html"))


def c3_html_blocks(spark, sf):
    return convert.html_blocks(texts(spark, sf, "pages", "page_id", "html"))


def c4_html_links(spark, sf):
    return convert.html_links(texts(spark, sf, "pages", "page_id", "html"))


def _quoted_pages(spark, sf):
    """Every page behind a paragraph whose attributes hold angle brackets, a link around a tag and an image."""
    number = F.col("page_id").cast("string")
    front = F.concat(F.lit("<p title=\"5 > 3\" class='<b>'>q <a title=\"a < b\" href=/x?n="), number,
                     F.lit("><span>text</span></a> <img alt='<p>' src=\"i"), number, F.lit(".png\"></p>"))
    return texts(spark, sf, "pages", "page_id", "html").select("page_id", F.concat(front, "html").alias("html"))


def c1_quoted_brackets(spark, sf):
    return convert.html_text(_quoted_pages(spark, sf))


def c2_quoted_brackets(spark, sf):
    return convert.html_to_markdown(_quoted_pages(spark, sf))


def c3_quoted_brackets(spark, sf):
    return convert.html_blocks(_quoted_pages(spark, sf))


def c4_quoted_brackets(spark, sf):
    return convert.html_links(_quoted_pages(spark, sf))


def c2_lists_and_links(spark, sf):
    """Lists in lists, links around blocks and images around the words of each document."""
    docs = texts(spark, sf, "documents", "doc_id", "text", "lang", "source").withColumn(
        "w", F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1))).where(F.size("w") > 6)
    w = [F.col("w")[k] for k in range(7)]
    html = F.concat(
        F.lit("<a href='/"), F.col("source"), F.lit("'><h2>"), w[0], F.lit(" <em>"), w[1], F.lit("</em></h2></a><OL><li>"), w[2], F.lit("<ul class=a><li>"),
        w[3], F.lit("<li><a href=http://x.org/"), F.col("doc_id").cast("string"), F.lit("><b>"), w[4], F.lit("</b></a><ol><li>"), w[5],
        F.lit("</ol></ul>then</li><li><img src=a.png alt='"), w[6], F.lit("'></li></OL>"), F.col("lang"))
    return convert.html_to_markdown(docs.select(F.col("doc_id").alias("page_id"), html.alias("html")))


def c5_markdown_to_html(spark, sf):
    return convert.markdown_to_html(markdown_docs(spark, sf))


def c5_markdown_structures(spark, sf):
    """Tables, lists in lists, underlined headings and references around the words of each document."""
    docs = texts(spark, sf, "documents", "doc_id", "text", "lang", "source", "n_chars").withColumn(
        "w", F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1))).where(F.size("w") > 8)
    w = [F.col("w")[k] for k in range(9)]
    markdown = F.concat(
        w[0], F.lit("\n===\n\n| "), w[1], F.lit(" | n |\n|---|--:|\n| **"), w[2], F.lit("** | "), F.col("n_chars").cast("string"), F.lit(" |\n"),
        w[3], F.lit("|\n\n* "), w[4], F.lit("\n  1. "), w[5], F.lit("\n  2. "), w[6], F.lit("\n     - "), F.col("lang"), F.lit("\n* ["), w[7],
        F.lit("][The  Source]\n\n"), w[8], F.lit("\n-----\n["), F.col("lang"), F.lit("](http://y.org/"), F.col("doc_id").cast("string"),
        F.lit(")\n\n[the source]: <http://x.org/"), F.col("source"), F.lit("> 'of it'\n"))
    return convert.markdown_to_html(docs.select("doc_id", markdown.alias("markdown")), standalone=False)


def c6_markdown_blocks(spark, sf):
    return convert.markdown_blocks(markdown_docs(spark, sf))


def c7_markdown_toc(spark, sf):
    return convert.markdown_toc(markdown_docs(spark, sf))


def _parts(spark, sf):
    kind = pick(["TEXT/Plain; charset=utf-8", "text/html", "image/png", "multipart/mixed"],
                (F.col("conv_id") * 7 + F.col("turn") * 5) % 4)
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("part_no"), kind.alias("content_type"),
        F.col("text").alias("content"))


def c8_email_body(spark, sf):
    return convert.email_body(_parts(spark, sf))


def c9_email_to_markdown(spark, sf):
    return convert.email_to_markdown(parsers.parse_eml(emails(spark, sf)))


def c9_email_to_markdown_columns(spark, sf):
    turn = table(spark, sf, "conversations")
    return convert.email_to_markdown(turn.select(
        _turn_id(), F.col("role").alias("subject"), F.lit("a@example.com").alias("from"),
        F.when(F.col("turn") > 0, F.col("role")).alias("to"), F.lit("").alias("date"), F.col("text").alias("body")))


def c10_format_addresses(spark, sf):
    turn = table(spark, sf, "conversations")
    address = F.concat("role", F.lit("@example.com"))
    listed = F.when(F.col("turn") % 3 == 0, F.lit(None)).otherwise(
        F.array_repeat(address, (F.col("turn") % 3).cast("int")))
    return convert.join_addresses(turn.select(_turn_id(), listed.alias("addresses")))


def c11_format_date(spark, sf):
    ts = F.when(F.col("event_id") % 10 > 0, F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", formats.format_date(ts).alias("date"))


UPPER = "y/abcdefghijklmnopqrstuvwxyz/ABCDEFGHIJKLMNOPQRSTUVWXYZ/;w {output}"


def x1_run_tool(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    command = F.when(F.col("doc_id") % 10 == 0, F.array(F.lit("false"))).otherwise(
        F.array(*[F.lit(x) for x in ("sed", "-n", UPPER, "{input}")]))
    done = tools.run_tool(docs, command, ".txt", "output.txt", timeout=60, parallel=16)
    return done.select("doc_id", T.decode_utf8(F.col("content")).alias("text"), "status", "exit_code")


def x2_ocr_language(spark, sf):
    code = pick(["", " ", "de", " FR ", "fra+eng", "Klingon", "zh"], F.col("doc_id") % 7)
    given = F.when(F.col("doc_id") % 4 == 0, F.col("lang")).when(F.col("doc_id") % 9 > 0, code)
    return table(spark, sf, "documents").select("doc_id", formats.ocr_language(given).alias("language"))


def x3_hhmmss(spark, sf):
    offset = F.when(F.col("doc_id") % 8 == 0, "x1").when(F.col("doc_id") % 9 == 0, " ").when(
        F.col("doc_id") % 10 > 0, F.concat(F.lit(" "), F.col("n_chars").cast("string")))
    return table(spark, sf, "documents").select("doc_id", formats.hhmmss(offset).alias("time"))


def x4_pick_output(spark, sf):
    turn = table(spark, sf, "conversations")
    name = pick(["input.txt", "a.txt", "b.txt", "log.json"], (F.col("conv_id") * 3 + F.col("turn") * 7) % 4)
    return tools.pick_output(turn.select(F.col("conv_id").alias("doc_id"), F.lit("input.mp3").alias("input_name"),
                                         name.alias("file_name")))


def x5_build_command(spark, sf):
    typed = routing.resolve_options(requests(spark, sf)).withColumn(
        "target_mime", F.when(F.col("request_id") % 2 == 0, values.PDF).otherwise(values.DOCX))
    return typed.select("request_id", *[
        F.array_join(tools.build_command(tool), " ").alias(tool)
        for tool in ("md2doc", "markdown", "ocr", "videothumb", "whisper")])


def q1_conformance(spark, sf):
    return quality.conformance(results(spark, sf)).select("doc_id", "engine", "result", "reason")


def q2_conformance_summary(spark, sf):
    return quality.conformance_summary(quality.conformance(results(spark, sf)))


def q2_failures(spark, sf):
    checked = quality.conformance(results(spark, sf))
    return quality.failures(checked).groupBy("engine", "failure").agg(F.count("*").alias("n"))


def q3_untested_pairs(spark, sf):
    routed = routing.route(requests(spark, sf), routing.builtin_registry(spark)).filter("status = 'ok'")
    matrix = routed.select(formats.engine_of(F.col("transformer")).alias("engine"), "source_mime", "target_mime")
    return quality.untested_pairs(routing.builtin_registry(spark), matrix.distinct())


def q4_probe_check(spark, sf):
    return quality.probe_check(results(spark, sf), quality.builtin_probes(spark)).select(
        "doc_id", "engine", "out_len", "expected", "tolerance", "in_range")


def q5_run_stats(spark, sf):
    return quality.run_stats(results(spark, sf))


def t1_stream_transform(spark, sf):
    root = shared_dir(spark) + "/t1-" + _unique()
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"), F.lit(values.HTML).alias("target_mime"),
        F.encode("html", "UTF-8").alias("content"))
    files.export_files(pages, f"{root}/in").write.format("noop").mode("overwrite").save()

    def request(docs: DataFrame) -> DataFrame:
        return docs.withColumn("target_mime", F.lit(values.MARKDOWN)).withColumn("options", option_map(F.lit(0)))

    jobs.stream_transform(
        spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", routing.builtin_registry(spark),
        {"html2md": transforms.html2md}, request).awaitTermination()
    return spark.read.parquet(f"{root}/out/queue=html2md-engine-queue").select(
        F.regexp_extract("doc_id", r"([0-9]+)\.html$", 1).cast("bigint").alias("page_id"),
        T.decode_utf8(F.col("content")).alias("markdown"), "status")


def _stream(spark, sf, name):
    # A file stream wants a folder or a glob; this glob matches exactly this table.
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}[.]parquet")


def t2_stream_redact(spark, sf):
    root = shared_dir(spark) + "/t2-" + _unique()
    stream = _stream(spark, sf, "documents").select("doc_id", "text")
    jobs.run_once(jobs.stream_redact(stream, "\n"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def t2_stream_metadata(spark, sf):
    """Raw metadata of pages and events as a stream of several batches."""
    root = shared_dir(spark) + "/t2m-" + _unique()
    meta = page_metadata(spark, sf).unionByName(event_metadata(spark, sf))
    meta.repartition(6, "doc_id").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(meta.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    mapping, _ = metadata.builtin_mapping(spark)
    jobs.run_once(jobs.stream_metadata(stream, mapping), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def t3_dedupe_requests(spark, sf):
    """Events as deliveries, two a request, in four batches that are out of order: every file holds every fourth hour."""
    root = shared_dir(spark) + "/t3-" + _unique()
    events = table(spark, sf, "events").select(F.floor(F.col("event_id") / 2).cast("bigint").alias("request_id"), "ts")
    (events.withColumn("file", F.pmod(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600, F.lit(4)).cast("int"))
     .repartition(4, "file").write.partitionBy("file").parquet(f"{root}/in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    jobs.run_deduped(stream, f"{root}/out", f"{root}/checkpoint", timedelta(days=1))
    return spark.read.parquet(f"{root}/out").select("request_id")


def u1_register_transformer(spark, sf):
    box = Toolbox(spark)
    box.register_transformer("quiet", [(values.TEXT, values.TEXT, 40_000)], ["language"], lambda docs: docs.select(
        "doc_id", "target_mime", F.encode(F.lower(T.decode_utf8(F.col("content"))), "UTF-8").alias("content"),
        F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error")))
    asked = table(spark, sf, "documents").select(
        "doc_id", F.lit(values.TEXT).alias("source_mime"), F.lit(values.TEXT).alias("target_mime"),
        (F.col("n_chars") * 4).alias("size"), option_map(F.col("doc_id") % 7).alias("options"),
        F.encode("text", "UTF-8").alias("content"))
    return box.transform(asked).select("doc_id", T.decode_utf8(F.col("content")).alias("text"), "status")


def u2_register_extractor(spark, sf):
    box = Toolbox(spark)
    box.register_extractor("size", lambda d: d.select(
        "doc_id", F.lit("n").alias("key"), F.col("n_chars").cast("string").alias("value")), "n=cm:size\n")
    box.register_extractor("where", lambda d: d.select(
        "doc_id", F.lit("from").alias("key"), F.col("source").alias("value")), "# own\nfrom=cm:source\n")
    return box.extract(table(spark, sf, "documents"))


def u3_embed_passthrough(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.lit(values.TEXT).alias("source_mime"), F.encode("text", "UTF-8").alias("content"))
    return metadata.embed_passthrough(docs).select(
        "doc_id", "source_mime", F.md5("content").alias("digest"), "status")


def u4_pii_spans(spark, sf):
    register_pii_spans(spark)
    doc_pages(spark, sf).createOrReplaceTempView("foliospark_pages")
    return spark.sql("SELECT doc_id, page_no, s.* FROM foliospark_pages, LATERAL pii_spans(text) s")


QUERIES: dict[str, Query] = {
    name: fn for name, fn in list(globals().items())
    if callable(fn) and name[0] in "srpamcxqtu" and name[1:2].isdigit()
}
