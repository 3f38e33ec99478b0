"""Conversion between HTML, Markdown and e-mail text over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foliospark.functions import html as H, markdown as M
from foliospark.functions.formats import format_addresses


def html_text(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", H.plain_text(F.col("html")).alias("text"))


def html_to_markdown(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", H.to_markdown(F.col("html")).alias("markdown"))


def html_blocks(pages: DataFrame) -> DataFrame:
    """Headings, paragraphs and list items as rows page_id, pos, tag, html."""
    return pages.select("page_id", F.posexplode(H.block_pieces(F.col("html"))).alias("pos", "b")).select(
        "page_id", "pos", "b.tag", "b.html")


def html_links(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.posexplode(H.link_pieces(F.col("html"))).alias("pos", "l")).select(
        "page_id", "pos", "l.href", "l.text")


def markdown_to_html(docs: DataFrame, standalone: bool = True) -> DataFrame:
    M.allow_nesting(docs.sparkSession)
    fragment = M.to_html(F.col("markdown"))
    if not standalone:
        return docs.select("doc_id", fragment.alias("html"))
    return docs.select("doc_id", M.standalone(fragment, F.col("doc_id").cast("string")).alias("html"))


def markdown_blocks(docs: DataFrame) -> DataFrame:
    """Lines as rows doc_id, pos, kind, level, text; lines inside fences have kind code."""
    return docs.select("doc_id", F.inline(M.lines(F.col("markdown"))))


def markdown_toc(docs: DataFrame, depth: int = 3) -> DataFrame:
    """Headings down to ``depth`` with number (1, 1.1, ...) and the id they have in ``markdown_to_html``; within the row."""
    found = docs.select("doc_id", F.filter(M.lines(F.col("markdown")), lambda x: x["kind"] == "heading").alias("heads"),
                        M.definitions(M.fence_parts(F.col("markdown"))).alias("known"))
    slugs = found.select("doc_id", "heads", F.transform("heads", lambda x: M.slug(M.spans(x["text"], F.col("known")))).alias("slugs"))
    named = slugs.select("doc_id", "heads", "slugs", M.seen_before(F.col("slugs")).alias("before"))
    anchors = F.zip_with("slugs", "before", M.unique)
    shown = named.select("doc_id", F.filter(F.arrays_zip(F.col("heads").alias("h"), anchors.alias("anchor")),
                                            lambda x: x["h"]["level"] <= depth).alias("shown"))
    heads = shown.select("doc_id", "shown", F.transform("shown", lambda x: x["h"]).alias("heads"))
    levels = range(1, depth + 1)
    counted = heads.select("doc_id", F.inline(F.arrays_zip("shown", *(M.since_above(F.col("heads"), k).alias(f"n{k}") for k in levels))))
    number = F.concat_ws(".", *(F.when(F.col("shown.h.level") >= k, F.col(f"n{k}")).cast("string") for k in levels))
    return counted.select("doc_id", "shown.h.pos", "shown.h.level", number.alias("number"), "shown.h.text", "shown.anchor")


def email_body(parts: DataFrame) -> DataFrame:
    """Body of each message from its top-level parts (doc_id, part_no, content_type, content).

    A single part is the body if it is text; of several the first text/plain,
    else the last text/html, else empty.
    """
    kind = F.lower("content_type")
    plain, rich = F.startswith(kind, F.lit("text/plain")), F.startswith(kind, F.lit("text/html"))
    text = F.startswith(kind, F.lit("text/"))
    # Other contents are never the body: they are blanked before the shuffle.
    slim = parts.select("doc_id", "part_no", plain.alias("plain"), rich.alias("rich"), text.alias("is_text"),
                        F.when(text, F.col("content")).alias("content"))
    return slim.groupBy("doc_id").agg(
        F.count("*").alias("parts"),
        F.min_by("content", F.when(F.col("plain"), F.col("part_no"))).alias("first_plain"),
        F.max_by("content", F.when(F.col("rich"), F.col("part_no"))).alias("last_rich"),
        F.max("content").alias("any_text"),
    ).select("doc_id", F.coalesce(
        F.when(F.col("parts") == 1, F.col("any_text")), "first_plain", "last_rich", F.lit("")).alias("body"))


def email_to_markdown(emails: DataFrame) -> DataFrame:
    """Subject as heading, From/To/Date lines, a rule and the body."""
    def line(name: str, column: str):
        return F.concat(F.lit(f"**{name}:** "), F.coalesce(column, F.lit("")), F.lit("\n\n"))

    return emails.select("doc_id", F.concat(
        F.lit("# "), F.coalesce("subject", F.lit("")), F.lit("\n\n"),
        line("From", "from"), line("To", "to"), line("Date", "date"),
        F.lit("---\n\n"), F.coalesce("body", F.lit("")), F.lit("\n")).alias("markdown"))


def join_addresses(rows: DataFrame, column: str = "addresses") -> DataFrame:
    return rows.withColumn(column, format_addresses(F.col(column)))
