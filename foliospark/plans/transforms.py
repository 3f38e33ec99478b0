"""The registered transforms as functions from routed requests to results.

Input: doc_id, source_mime, target_mime, content and the typed option columns.
Output: doc_id, target_mime, content, status, error. Formats that only a
program can read or write go through ``tools.convert``; where the program is
missing the documents come back with status error.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from foliospark import values
from foliospark.functions import html as H, markdown as M
from foliospark.functions.text import decode_utf8
from foliospark.operators import convert, describe, metadata, pii, tools
from foliospark.operators.routing import resolve_options
from foliospark.operators.tables import union_by
from foliospark.sources import parsers

RESULT = ["doc_id", "target_mime", "content", "status", "error"]


def no_error() -> Column:
    return F.lit(None).cast("string").alias("error")


def _text_result(docs: DataFrame, text: Column) -> DataFrame:
    return docs.select("doc_id", "target_mime", F.encode(text, "UTF-8").alias("content"),
                       F.lit("ok").alias("status"), no_error())


def html2md(docs: DataFrame) -> DataFrame:
    return _text_result(docs, H.to_markdown(decode_utf8(F.col("content"))))


def md2html(docs: DataFrame) -> DataFrame:
    M.allow_nesting(docs.sparkSession)
    fragment = M.to_html(decode_utf8(F.col("content")))
    return _text_result(docs, M.standalone(fragment, F.col("doc_id").cast("string")))


def by_tool(tool: str, timeout: float | None = None, **paths) -> Callable[[DataFrame], DataFrame]:
    """A transform that runs a known external tool; ``timeout`` in seconds for each document, none by default."""
    def run(docs: DataFrame) -> DataFrame:
        typed = docs if "warnings" in docs.columns else resolve_options(docs)
        return tools.convert(typed, tool, timeout, keep=("target_mime",), **paths).select(
            "doc_id", "target_mime", "content", "status", F.when(F.col("status") != "ok", F.col("log")).alias("error"))
    return run


def msg(docs: DataFrame, timeout: float | None = None) -> DataFrame:
    """E-mail to PDF: parsed and laid out as Markdown here, rendered by the tool."""
    eml = docs.filter(F.col("source_mime") == values.EML)
    parsed = parsers.parse_eml(eml)
    markdown = convert.email_to_markdown(parsed.filter(F.col("status") == "ok"))
    pages = markdown.select("doc_id", F.encode("markdown", "UTF-8").alias("content"))
    done = tools.convert(pages, "msg", timeout).select(
        "doc_id", F.lit(values.PDF).alias("target_mime"), "content", "status",
        F.when(F.col("status") != "ok", F.col("log")).alias("error"))
    binary = docs.filter(F.col("source_mime") != values.EML).select(
        "doc_id", "target_mime", F.lit(None).cast("binary").alias("content"),
        F.lit("unsupported").alias("status"), F.lit("binary mail format").alias("error"))
    failed = parsed.filter(F.col("status") != "ok").select(
        "doc_id", F.lit(values.PDF).alias("target_mime"), F.lit(None).cast("binary").alias("content"), "status", "error")
    return done.unionByName(binary).unionByName(failed)


def metadata_result(meta: DataFrame, extractor: str) -> DataFrame:
    """Long metadata to one JSON object per document in content-model names."""
    mapping, _ns = metadata.builtin_mapping(meta.sparkSession)
    rows = meta.select("doc_id", F.lit(extractor).alias("extractor"), "key", "value")
    resolved = metadata.resolve_collisions(metadata.map_metadata(rows, mapping))
    return metadata.metadata_json(resolved).select(
        "doc_id", F.lit(values.METADATA).alias("target_mime"),
        F.encode("metadata_json", "UTF-8").alias("content"), F.lit("ok").alias("status"), no_error())


def _with_failures(results: DataFrame, rows: DataFrame) -> DataFrame:
    failed = rows.filter(F.col("status") != "ok").select(
        "doc_id", F.lit(values.METADATA).alias("target_mime"), F.lit(None).cast("binary").alias("content"),
        "status", "error")
    return results.unionByName(failed)


def _for_every(docs: DataFrame, results: DataFrame) -> DataFrame:
    """One result for each document; where nothing was found, the metadata is an empty object."""
    found = union_by("doc_id", results)
    empty = F.col("status").isNull()
    return docs.select("doc_id").distinct().join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("target_mime", F.lit(values.METADATA)).alias("target_mime"),
        F.when(empty, F.encode(F.lit("{}"), "UTF-8")).otherwise(F.col("content")).alias("content"),
        F.when(empty, "ok").otherwise(F.col("status")).alias("status"), "error")


def xmlextract(docs: DataFrame) -> DataFrame:
    rows = parsers.parse_xml(docs, "content")
    found = metadata_result(metadata.last_of_each_key(rows.filter("status = 'ok'")), "xml")
    return _for_every(docs, _with_failures(found, rows))


def excelextract(docs: DataFrame) -> DataFrame:
    rows = parsers.read_xlsx_properties(docs)
    found = metadata_result(metadata.xlsx_metadata(rows.filter("status = 'ok'")), "excel")
    return _for_every(docs, _with_failures(found, rows))


def pdf_text(docs: DataFrame, command: list[str] | None = None, timeout: float | None = None) -> DataFrame:
    """Text of PDF files by an external tool; pages end with a form feed."""
    done = tools.run_tool(docs, command or ["pdftotext", "-enc", "UTF-8", "{input}", "{output}"], ".pdf", "output.txt", timeout)
    return done.select("doc_id", decode_utf8(F.col("content")).alias("text"), "status", F.col("log").alias("error"))


def pdf_pii_metadata(docs: DataFrame, timeout: float | None = None) -> DataFrame:
    texts = pdf_text(docs, timeout=timeout)
    summary = pii.summarise_documents(texts.filter("status = 'ok'").select("doc_id", "text"))
    return _for_every(docs, _with_failures(metadata_result(pii.pii_metadata(summary), "pii"), texts))


def ai_metadata(docs: DataFrame) -> DataFrame:
    """Descriptive metadata from the texts alone (see ``describe`` for the model path)."""
    plain = docs.filter(F.col("source_mime") == values.TEXT).select(
        "doc_id", decode_utf8(F.col("content")).alias("text"))
    meta = describe_offline(plain)
    pdf = docs.filter(F.col("source_mime") != values.TEXT).select(
        "doc_id", F.lit("unsupported").alias("status"), F.lit("text of PDF needs an external tool").alias("error"))
    return _for_every(docs, _with_failures(metadata_result(meta, "ai"), pdf))


def describe_offline(texts: DataFrame) -> DataFrame:
    """Title, description, tags and language of each text as long metadata."""
    tags = describe.offline_tags(texts)
    joined = tags.groupBy("doc_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda t: t["word"]).alias("words"))
    def rows(df: DataFrame, key: str, value: str | Column) -> DataFrame:
        return df.select("doc_id", F.lit(key).alias("key"), (F.col(value) if isinstance(value, str) else value).alias("value"))

    return union_by(
        "doc_id",
        rows(describe.offline_title(texts), "ai.title", "title"),
        rows(describe.offline_description(texts), "ai.description", "description"),
        rows(joined, "ai.taggable", F.array_join("words", ", ")),
        rows(describe.offline_language(texts), "ai.locale", "language")).filter("value is not null")


def builtin_transforms(scripts: dict[str, str] | None = None,
                       timeout: float | None = None) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """All registered transformers by name. ``scripts`` gives the paths of the
    Python scripts behind pdf2docx, convert2md and pii; ``timeout`` bounds the
    seconds an external program may take for a document."""
    table = {
        "html2md": html2md, "md2html": md2html, "msg": partial(msg, timeout=timeout), "xmlextract": xmlextract,
        "excelextract": excelextract, "pdf-pii-metadata": partial(pdf_pii_metadata, timeout=timeout), "ai-metadata": ai_metadata,
        **{tool: by_tool(tool, timeout) for tool in ("md2doc", "markdown", "ocr", "whisper", "videothumb", "heic")},
    }
    for name, tool in (("pdf2docx", "pdf2docx"), ("convert2md", "convert2md"), ("pdf-pii-redaction", "pii")):
        if scripts and tool in scripts:
            table[name] = by_tool(tool, timeout, script=scripts[tool])
    return table
