"""Checks on results: which passed, which pairs are untested, how long they took."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foliospark import values
from foliospark.functions.formats import engine_of, is_metadata
from foliospark.operators.tables import small_table


def builtin_matrix(spark: SparkSession) -> DataFrame:
    return small_table(spark, values.MATRIX, "engine string, source_mime string, target_mime string, extra string")


def builtin_probes(spark: SparkSession) -> DataFrame:
    rows = [(engine, *sizes) for engine, sizes in values.PROBES.items()]
    return small_table(spark, rows, "engine string, expected bigint, tolerance bigint")


def conformance(results: DataFrame) -> DataFrame:
    """PASS or FAIL and the reason for each result."""
    keys = F.json_object_keys("metadata_json")
    reason = (F.when(F.col("status") != "ok", F.coalesce("error", F.lit("no message")))
               .when(is_metadata(F.col("target_mime")) & keys.isNull(), "invalid JSON response")
               .when(is_metadata(F.col("target_mime")) & (F.size(keys) == 0), "empty metadata: no properties extracted")
               .when(~is_metadata(F.col("target_mime")) & (F.coalesce("out_len", F.lit(0)) == 0),
                     "empty response body"))
    return results.withColumn("reason", reason).withColumn(
        "result", F.when(F.col("reason").isNull(), "PASS").otherwise("FAIL"))


def conformance_summary(checked: DataFrame) -> DataFrame:
    """Passed, failed and total per engine and overall (engine null), with the number of
    different reasons. Single failures stay rows: see ``failures``."""
    failed = F.col("result") == "FAIL"
    return checked.rollup("engine").agg(
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count("*").alias("total"))


def failures(checked: DataFrame) -> DataFrame:
    """The failed results, one row each: a list of any length that stays distributed."""
    return checked.filter(F.col("result") == "FAIL").select(
        "engine", F.format_string("[%s] %s -> %s (%s)", "engine", "source_mime", "target_mime", "reason")
        .alias("failure"))


def untested_pairs(registry: DataFrame, matrix: DataFrame) -> DataFrame:
    """Registry rows that no row of the test matrix covers."""
    rows = registry.select(engine_of(F.col("transformer")).alias("engine"), "source_mime", "target_mime")
    return rows.join(matrix, ["engine", "source_mime", "target_mime"], "left_anti").distinct()


def probe_check(results: DataFrame, probes: DataFrame) -> DataFrame:
    """Is the output of each engine's self-test as long as expected, within its tolerance?"""
    return results.join(probes, "engine").withColumn(
        "in_range", F.abs(F.col("out_len") - F.col("expected")) <= F.col("tolerance"))


def run_stats(results: DataFrame) -> DataFrame:
    """Documents, failures, bytes and seconds per transformer."""
    return results.groupBy("transformer").agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("status") != "ok").alias("failed"),
        F.sum("bytes_in").alias("bytes_in"),
        F.sum("bytes_out").alias("bytes_out"),
        F.percentile_approx("seconds", 0.5).alias("p50_seconds"),
        F.percentile_approx("seconds", 0.95).alias("p95_seconds"))
