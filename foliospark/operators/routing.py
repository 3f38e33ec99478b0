"""Registry, routing and options.

A request is routed inside its row: the registry is folded to one row per
(source, target) with its candidates, so routing is one map-side join with a
table of a few dozen rows and no window over the requests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliospark import values
from foliospark.functions.formats import is_metadata, whole_number
from foliospark.functions.text import trim_control
from foliospark.operators.tables import small_table

REGISTRY = "transformer string, source_mime string, target_mime string, max_bytes bigint, options array<string>"

_CONFIG = ("transformOptions map<string,array<struct<value:struct<name:string,required:boolean>>>>, "
           "transformers array<struct<transformerName:string, "
           "supportedSourceAndTargetList:array<struct<sourceMediaType:string,targetMediaType:string,"
           "maxSourceSizeBytes:bigint>>, transformOptions:array<string>>>")


def one_target(mime: Column) -> Column:
    """Every spelling of the metadata target becomes the same one."""
    return F.when(is_metadata(mime), F.lit(values.METADATA)).otherwise(mime)


def builtin_registry(spark: SparkSession) -> DataFrame:
    rows = [(name, source, target, limit, options)
            for name, _engine, options, groups in values.TRANSFORMERS
            for sources, targets, limit in groups for source in sources for target in targets]
    return small_table(spark, rows, REGISTRY)


def load_registry(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Registry JSON files to one row per supported pair, option groups resolved to names."""
    config = spark.read.schema(_CONFIG).json(path, multiLine=True)
    transformer = config.select("transformOptions", F.explode("transformers").alias("t"))
    pairs = transformer.select("transformOptions", "t", F.explode("t.supportedSourceAndTargetList").alias("p"))
    groups = F.coalesce(F.col("t.transformOptions"), F.array().cast("array<string>"))
    names = F.flatten(F.transform(groups, lambda g: F.coalesce(
        F.transform(F.col("transformOptions")[g], lambda o: o["value"]["name"]), F.array().cast("array<string>"))))
    return pairs.select(
        F.col("t.transformerName").alias("transformer"),
        F.col("p.sourceMediaType").alias("source_mime"),
        one_target(F.col("p.targetMediaType")).alias("target_mime"),
        F.col("p.maxSourceSizeBytes").alias("max_bytes"),
        names.alias("options"))


def merge_registries(*registries: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), registries)


def ambiguous_pairs(registry: DataFrame) -> DataFrame:
    """Pairs that more than one transformer serves."""
    return registry.groupBy("source_mime", "target_mime").agg(
        F.countDistinct("transformer").alias("n"),
        F.array_join(F.array_sort(F.collect_set("transformer")), ",").alias("transformers"),
    ).filter(F.col("n") > 1)


def _candidates(registry: DataFrame) -> DataFrame:
    return registry.groupBy("source_mime", "target_mime").agg(
        F.collect_list(F.struct("transformer", "max_bytes", "options")).alias("_candidates"))


def _fitting(candidates: Column) -> Column:
    return F.filter(candidates, lambda c: c["max_bytes"].isNull() | (F.col("size") <= c["max_bytes"]))


def route(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``transformer`` and ``status`` to every request.

    Chosen is a transformer with this source and target, room for ``size`` and
    all requested options; of several the one with the fewest other options,
    then the first by name. Requests without one keep their row with status
    unsupported, unknown_size (null where every candidate has a limit), too_large or bad_option.
    """
    asked = F.coalesce(F.map_keys("options"), F.array().cast("array<string>"))
    joined = requests.withColumn("target_mime", one_target(F.col("target_mime"))).join(
        _candidates(registry), ["source_mime", "target_mime"], "left")
    fitting = joined.withColumn("_fitting", _fitting(F.col("_candidates")))
    able = F.filter("_fitting", lambda c: F.size(F.array_except(asked, c["options"])) == 0)
    best = F.array_min(F.transform(able, lambda c: F.struct(
        (F.size(c["options"]) - F.size(asked)).alias("extra"), c["transformer"].alias("transformer"))))
    chosen = fitting.withColumn("_best", best)
    status = (F.when(F.col("_candidates").isNull(), "unsupported")
               .when((F.size("_fitting") == 0) & F.col("size").isNull(), "unknown_size")
               .when(F.size("_fitting") == 0, "too_large")
               .when(F.col("_best").isNull(), "bad_option")
               .otherwise("ok"))
    return chosen.select(*requests.columns, F.col("_best.transformer").alias("transformer"), status.alias("status"))


def unsupported(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requests whose pair nobody serves."""
    pairs = registry.select("source_mime", "target_mime").distinct()
    return requests.withColumn("target_mime", one_target(F.col("target_mime"))).join(
        pairs, ["source_mime", "target_mime"], "left_anti").select(*requests.columns)


def oversized(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requests whose pair is served, but by nobody at this size; adds the greatest limit."""
    joined = requests.withColumn("target_mime", one_target(F.col("target_mime"))).join(
        _candidates(registry), ["source_mime", "target_mime"])
    return joined.filter(F.size(_fitting(F.col("_candidates"))) == 0).select(
        *requests.columns,
        F.array_max(F.transform("_candidates", lambda c: c["max_bytes"])).alias("limit_bytes"))


# Options whose blank value stands as given; for all others blank means the default.
_BLANK_STANDS = {"entities", "label", "aiFields"}


def resolve_options(df: DataFrame, defaults: dict[str, tuple] | None = None) -> DataFrame:
    """String options to typed columns with defaults; unreadable numbers are named in ``warnings``."""
    table = values.OPTION_DEFAULTS if defaults is None else defaults
    columns, warnings = [], []
    for name, (kind, default) in table.items():
        raw = F.col("options")[name]
        text = trim_control(raw)
        if kind == "string":
            given = raw.isNotNull() if name in _BLANK_STANDS else F.coalesce(text, F.lit("")) != ""
            columns.append(F.when(given, raw).otherwise(F.lit(default)).alias(name))
        elif kind == "boolean":
            columns.append(F.when(F.coalesce(text, F.lit("")) == "", F.lit(default))
                            .otherwise(F.lower(text) == "true").alias(name))
        else:
            number = whole_number(raw) if kind == "int" else text.try_cast("double")
            columns.append(F.coalesce(number, F.lit(default)).cast(kind).alias(name))
            blank_is_bad = F.lit(kind == "double")
            warnings.append(F.when(raw.isNotNull() & number.isNull() & (blank_is_bad | (text != "")), F.lit(name)))
    return df.select(*df.columns, *columns, F.concat_ws(",", *warnings).alias("warnings"))
