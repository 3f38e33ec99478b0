"""Metadata in long form (doc_id, extractor, key, value) and its mapping to properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliospark import values
from foliospark.functions.text import trim_control
from foliospark.operators.tables import small_table, union_by

# White space that makes a value blank (no-break spaces do not).
_VISIBLE = "[^\t-\r\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]"


def put_if_not_blank(meta: DataFrame) -> DataFrame:
    """Drop null and blank values, trim the rest."""
    return meta.filter(F.regexp_like("value", F.lit(_VISIBLE))).withColumn("value", trim_control(F.col("value")))


def last_of_each_key(rows: DataFrame) -> DataFrame:
    """Repeated keys of a document: the last one that is not blank wins."""
    return put_if_not_blank(rows).groupBy("doc_id", "key").agg(F.max_by("value", "pos").alias("value"))


def guard_doctype(docs: DataFrame, text: str = "xml") -> DataFrame:
    """Status error for every text with a DOCTYPE; such texts must not be parsed.

    Within comments, CDATA sections and processing instructions the word is text like any other.
    """
    declared = F.regexp_replace(
        text, r"(?s)<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)|<\?.*?(?:\?>|\z)", "")
    found = F.regexp_like(declared, F.lit("(?i)<!DOCTYPE"))
    return docs.withColumn("status", F.when(found, "error").otherwise("ok")).withColumn(
        "error", F.when(found, "DOCTYPE is not allowed"))


def parse_mapping(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (extractor, text) of property lines to the tables ``mapping`` and ``ns``."""
    line = F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line")
    lines = texts.select("extractor", line).select(
        "extractor", "pos", F.regexp_extract("line", r"^\s*([^#!=\s][^=]*?)\s*=\s*(.*?)\s*$", 1).alias("name"),
        F.regexp_extract("line", r"^\s*([^#!=\s][^=]*?)\s*=\s*(.*?)\s*$", 2).alias("target")).filter("name != ''")
    prefix = "namespace.prefix."
    declared = F.startswith("name", F.lit(prefix))
    ns = lines.filter(declared).select(
        F.substring(F.col("name"), F.lit(len(prefix) + 1), F.length("name")).alias("prefix"), F.col("target").alias("uri")).distinct()
    mapping = lines.filter(~declared).select(
        "extractor", F.col("name").alias("raw_key"),
        F.split_part("target", F.lit(":"), F.lit(1)).alias("prefix"),
        F.split_part("target", F.lit(":"), F.lit(2)).alias("local"),
        F.col("pos").alias("priority"))
    return mapping, ns


def load_mapping(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Property files to ``mapping`` and ``ns``; the extractor is the file name without extension."""
    texts = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]*)", 1).alias("extractor"),
        F.col("value").alias("text"))
    return parse_mapping(texts)


def builtin_mapping(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    mapping, _ = parse_mapping(small_table(spark, list(values.MAPPINGS.items()), "extractor string, text string"))
    return mapping, small_table(spark, list(values.NAMESPACES.items()), "prefix string, uri string")


def map_metadata(meta: DataFrame, mapping: DataFrame) -> DataFrame:
    """Raw keys to properties; keys without a mapping are dropped."""
    table = mapping.select("extractor", F.col("raw_key").alias("key"), "prefix", "local", "priority")
    return meta.join(table, ["extractor", "key"]).select(
        "doc_id", "extractor", F.concat_ws(":", "prefix", "local").alias("property"), "value", "priority")


def resolve_collisions(mapped: DataFrame, policy: str = "first", sep: str = "\n") -> DataFrame:
    """One value per document and property when several keys map to it.

    ``first`` and ``last`` go by mapping order, then extractor; ``concat`` joins
    all values in that order.
    """
    order = F.struct("priority", "extractor")
    if policy == "first":
        value = F.min_by("value", order)
    elif policy == "last":
        value = F.max_by("value", order)
    elif policy == "concat":
        listed = F.array_sort(F.collect_list(F.struct("priority", "extractor", "value")))
        value = F.array_join(F.transform(listed, lambda x: x["value"]), sep)
    else:
        raise ValueError(f"unknown policy: {policy}")
    return mapped.groupBy("doc_id", "property").agg(value.alias("value"))


def expand_qname(resolved: DataFrame, ns: DataFrame) -> DataFrame:
    """``cm:title`` to ``{uri}title``; an unknown prefix gives status error."""
    prefix = F.split_part("property", F.lit(":"), F.lit(1))
    local = F.split_part("property", F.lit(":"), F.lit(2))
    joined = resolved.withColumn("prefix", prefix).join(ns, "prefix", "left")
    known = F.col("uri").isNotNull()
    return joined.select(
        "doc_id", "property",
        F.when(known, F.concat(F.lit("{"), F.col("uri"), F.lit("}"), local)).alias("qname"),
        "value",
        F.when(known, "ok").otherwise("error").alias("status"),
        F.when(~known, F.concat(F.lit("unknown prefix "), F.col("prefix"))).alias("error"))


def merge_metadata(**metas: DataFrame) -> DataFrame:
    """Long metadata of several extractors in one table, extractor name kept."""
    return union_by("doc_id", *[
        meta.select("doc_id", F.lit(name).alias("extractor"), "key", "value") for name, meta in metas.items()])


def metadata_json(rows: DataFrame, key: str = "property") -> DataFrame:
    """One JSON object per document, keys sorted; needs one value per key."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key), F.col("value"))))
    return rows.groupBy("doc_id").agg(F.to_json(F.map_from_entries(entries)).alias("metadata_json"))


def xlsx_metadata(properties: DataFrame) -> DataFrame:
    """Workbook properties (from ``read_xlsx_properties``) as clean long metadata."""
    return put_if_not_blank(properties.select("doc_id", "key", "value"))


def embed_passthrough(docs: DataFrame) -> DataFrame:
    """Embedding is not supported by any extractor: the content comes back unchanged."""
    return docs.select("doc_id", "source_mime", "content", F.lit("ok").alias("status"))


def metadata_column(value: str | Column, key: str) -> Column:
    """A struct (key, value) for building long metadata from columns with ``inline(array(...))``."""
    column = F.col(value) if isinstance(value, str) else value
    return F.struct(F.lit(key).alias("key"), column.cast("string").alias("value"))
