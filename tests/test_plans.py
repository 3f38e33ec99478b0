"""What the plans must look like to hold on large data."""

import pytest
from pyspark.sql import functions as F

from foliospark.operators import convert, describe, metadata, pii, routing, tables
from foliospark.plans import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def pages(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet")


def test_row_wise_operators_do_not_shuffle(spark, sf, docs, pages):
    markdown = docs.select("doc_id", F.col("text").alias("markdown"))
    for df in (
        pii.split_pages(docs), pii.detect_pii(pii.split_pages(docs)), pii.summarise_documents(docs),
        pii.redact_documents(docs, everywhere=True), pii.pii_metadata(pii.summarise_documents(docs)),
        convert.html_text(pages), convert.html_to_markdown(pages), convert.html_blocks(pages), convert.html_links(pages),
        convert.markdown_to_html(markdown), convert.markdown_blocks(markdown),
        describe.offline_title(docs), describe.offline_language(docs), describe.build_requests(docs),
        routing.resolve_options(catalog.requests(spark, sf)), metadata.put_if_not_blank(catalog.page_metadata(spark, sf)),
    ):
        assert "Exchange" not in plan(df), plan(df)


def test_routing_and_mapping_are_map_side_joins(spark, sf):
    registry = routing.builtin_registry(spark)
    asked = catalog.requests(spark, sf)
    mapping, ns = metadata.builtin_mapping(spark)
    for df in (routing.route(asked, registry), routing.unsupported(asked, registry), routing.oversized(asked, registry),
               metadata.map_metadata(catalog.page_metadata(spark, sf), mapping)):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_large_side_tables_are_not_broadcast(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        names = spark.range(1_000_000).select(F.col("id").cast("string").alias("name"))
        text = plan(pii.detect_names(catalog.doc_pages(spark, sf), names))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_columns_and_filters_reach_the_scan(spark, sf):
    text = plan(pii.summarise_documents(spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en'")))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in text
    routed = plan(routing.route(catalog.requests(spark, sf), routing.builtin_registry(spark)))
    assert "text:string" not in routed


def test_no_cross_joins(spark, sf):
    for name in ("a10_offline_tags", "a12_offline_description", "p8_redact_spans", "p9_redact_occurrences", "q3_untested_pairs"):
        text = plan(catalog.QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_words_are_counted_inside_the_row(docs):
    text = plan(describe.word_scores(docs.select("doc_id", "text")))
    assert "hashpartitioning(doc_id" not in text and "CartesianProduct" not in text
    assert all("text" not in line for line in text.splitlines() if "Exchange" in line)


def test_grouping_a_union_gives_each_key_once(spark):
    a = spark.range(1000).repartition(8, "id")
    b = spark.range(1000).repartition(8, "id").join(F.broadcast(spark.range(500)), "id", "left")
    assert tables.union_by("id", a, b).groupBy("id").count().filter("count = 2").count() == 1000


def test_hot_keys_are_spread(spark):
    """A third of all rows share one document or one word; results stay whole."""
    docs = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "samesame").otherwise(
        F.concat(F.lit("word"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))).alias("text")).withColumnRenamed("id", "doc_id")
    scores = describe.word_scores(docs)
    assert scores.count() == 3000
    assert scores.filter("word = 'samesame'").select("df").distinct().first().df == 1000
    parts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
                                     F.col("id").alias("part_no"), F.lit("text/plain").alias("content_type"),
                                     F.col("id").cast("string").alias("content"))
    bodies = convert.email_body(parts)
    assert bodies.count() == 2001 and bodies.filter("doc_id = 0").first().body == "0"
