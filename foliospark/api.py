"""User extensions: own transformers, own extractors, and PII as a table function."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import udtf

from foliospark import values
from foliospark.operators import metadata, routing
from foliospark.operators.tables import small_table

Transform = Callable[[DataFrame], DataFrame]


class Toolbox:
    """A registry with the functions behind it."""

    def __init__(self, spark: SparkSession, registry: DataFrame | None = None,
                 transforms: dict[str, Transform] | None = None):
        self.spark = spark
        self._registry = routing.builtin_registry(spark) if registry is None else registry
        self._transforms = dict(transforms or {})
        self._extractors: dict[str, tuple[Transform, str]] = {}

    @property
    def registry(self) -> DataFrame:
        return self._registry

    def register_transformer(self, name: str, pairs: list[tuple], options: list[str], fn: Transform) -> None:
        """Add a transformer. ``pairs`` holds (source, target) or (source, target, max bytes)."""
        rows = [(name, p[0], p[1], p[2] if len(p) > 2 else None, options) for p in pairs]
        self._registry = routing.merge_registries(
            self._registry, small_table(self.spark, rows, routing.REGISTRY))
        self._transforms[name] = fn

    def register_extractor(self, name: str, fn: Transform, mapping: str) -> None:
        """Add a metadata extractor: documents to rows doc_id, key, value, and its property lines."""
        self._extractors[name] = (fn, mapping)

    def transform(self, requests: DataFrame, staging: str | None = None) -> DataFrame:
        """Route requests and run the transformers registered here, each on its own rows.

        Requests that are not routed, or whose transformer has no function, keep
        a row with their status. Each transformer filters the routed requests,
        so their source is scanned once per transformer; with ``staging`` (a
        new folder all executors share) they are routed and written once,
        partitioned by transformer, and each transformer reads only its part.
        """
        routed = routing.route(requests, self._registry)
        if staging is not None:
            unrouted = "-"
            routed.withColumn("transformer", F.coalesce("transformer", F.lit(unrouted))).write.partitionBy(
                "transformer").parquet(staging)
            routed = self.spark.read.schema(routed.schema).parquet(staging).withColumn(
                "transformer", F.nullif("transformer", F.lit(unrouted)))
        results = [fn(routed.filter(F.col("transformer") == name)).select(
            "doc_id", "target_mime", "content", "status", "error")
            for name, fn in self._transforms.items()]
        known = F.coalesce(F.col("transformer").isin(list(self._transforms)), F.lit(False))
        rest = routed.filter(~known).select(
            "doc_id", "target_mime", F.lit(None).cast("binary").alias("content"),
            F.when(F.col("status") == "ok", "unsupported").otherwise(F.col("status")).alias("status"),
            F.lit(None).cast("string").alias("error"))
        return reduce(lambda a, b: a.unionByName(b), [*results, rest])

    def extract(self, docs: DataFrame, policy: str = "first") -> DataFrame:
        """Properties of every registered extractor, mapped and without collisions."""
        if not self._extractors:
            raise ValueError("no extractor is registered")
        meta = metadata.merge_metadata(**{name: fn(docs) for name, (fn, _) in self._extractors.items()})
        texts = [(name, lines) for name, (_, lines) in self._extractors.items()]
        mapping, _ns = metadata.parse_mapping(small_table(self.spark, texts, "extractor string, text string"))
        return metadata.resolve_collisions(
            metadata.map_metadata(metadata.put_if_not_blank(meta), mapping), policy)


def register_pii_spans(spark: SparkSession, name: str = "pii_spans") -> None:
    """``SELECT ... FROM documents, LATERAL pii_spans(text)``.

    For ad-hoc SQL; jobs use ``operators.pii``, which stays in the JVM.
    """
    catalogue = [(e, p, s, v) for e, p, _run, _needle, s, v in values.RECOGNIZERS]

    class PiiSpans:
        def __init__(self):
            import re
            self.patterns = [(e, re.compile(p, re.ASCII), s, v) for e, p, s, v in catalogue]

        def eval(self, text: str):
            for entity, pattern, score, validator in self.patterns:
                for m in pattern.finditer(text or ""):
                    if validator == "luhn":
                        digits = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(m.group()))]
                        if sum(d - 9 if d > 9 else d for d in digits) % 10:
                            continue
                    yield entity, m.start(), m.end(), m.group(), score

    spark.udtf.register(name, udtf(
        PiiSpans, returnType="entity_type string, start int, end int, matched string, score double"))
