"""Documents that arrive over time: routed, transformed and redacted as streams."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from foliospark import values
from foliospark.operators import metadata, pii
from foliospark.operators.routing import route
from foliospark.sources.files import FILES_PER_BATCH, stream_documents

Transform = Callable[[DataFrame], DataFrame]

# Spark looks up each file of a batch once more, and beyond this many by a job with a task, and so a result for the driver,
# for each file. The driver does it itself here, at most FILES_PER_BATCH files at a time.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.threshold"
# What opening a file counts, in bytes: at the usual 4 MB a task reads only a handful of small files.
OPENING, SMALL = "spark.sql.files.openCostInBytes", str(64 * 1024)


def stream_transform(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, registry: DataFrame,
                     transforms: dict[str, Transform], request: Transform, once: bool = True) -> StreamingQuery:
    """Route new files and transform them, one output folder per queue.

    ``request`` adds ``target_mime`` and ``options`` to the documents. Each
    micro-batch writes to a folder of its own, in overwrite mode: a batch that
    is repeated after a failure replaces its own output and nothing else.
    Requests that were not routed go to ``rejected`` with their status. From then on the session looks up as many paths
    as a batch has files on the driver, and counts little for opening a file.
    """
    engines = {name: engine for name, engine, *_ in values.TRANSFORMERS}
    queues = {name: engines.get(name, name) + values.QUEUE_SUFFIX for name in transforms}

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = route(request(batch), registry).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, transform in transforms.items():
                mine = routed.filter(F.col("transformer") == name)
                transform(mine).write.mode("overwrite").parquet(
                    f"{out_dir}/queue={queues[name]}/transformer={name}/batch={batch_id}")
            known = F.coalesce(F.col("transformer").isin(list(transforms)), F.lit(False))
            routed.filter(~known).select("doc_id", "source_mime", "target_mime", "size", F.when(
                F.col("status") == "ok", "no such transformer here").otherwise(F.col("status")).alias("status")
            ).write.mode("overwrite").parquet(f"{out_dir}/rejected/batch={batch_id}")
        finally:
            routed.unpersist()

    writer = stream_documents(spark, in_dir).writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint)
    # The source asks the session it was made in, in each batch.
    spark.conf.set(LISTING, str(max(FILES_PER_BATCH, int(spark.conf.get(LISTING)))))
    spark.conf.set(OPENING, SMALL)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def stream_redact(docs: DataFrame, sep: str = "\f", entities: str | None = None, threshold: float | None = None,
                  label: str = values.DEFAULT_LABEL) -> DataFrame:
    """Redaction on a streaming table of texts: in-row, without state."""
    return pii.redact_documents(docs, sep, entities=entities, threshold=threshold, label=label)


def stream_metadata(meta: DataFrame, mapping: DataFrame) -> DataFrame:
    """Clean and map long metadata on a stream: a stream-static join, without state."""
    return metadata.map_metadata(metadata.put_if_not_blank(meta), mapping)


ARRIVED = "_arrived"


def dedupe_requests(requests: DataFrame, within: timedelta = timedelta(hours=1), key: str = "request_id") -> DataFrame:
    """The first delivery of each request; one that comes in again before ``within`` has passed is dropped.

    Time is the clock at which a batch comes in, not the time written in a row: the watermark that ends the state then
    never runs ahead of a row, so no first delivery is lost however late its own time is. Null keys are one request.
    State is a key for each request of the last ``within``, in the executors' state store.
    """
    stamped = requests.withColumn(ARRIVED, F.current_timestamp())
    return (stamped.withWatermark(ARRIVED, f"{max(1, int(within.total_seconds()))} seconds")
            .dropDuplicatesWithinWatermark([key]).drop(ARRIVED))


def run_deduped(requests: DataFrame, out_dir: str, checkpoint: str, within: timedelta = timedelta(hours=1), key: str = "request_id",
                ts: str = "ts") -> None:
    """First deliveries into ``out_dir/batch=N/late=false`` and, where late, into ``late=true``; all there is, then stop.

    A row is late whose own time lies more than ``within`` behind the newest one let through by the batches before. That
    time is kept by batch beside the checkpoint, so a batch that is repeated after a failure is cut the same way, and
    replaces its own folder only.
    """
    spark = requests.sparkSession
    newest_dir = f"{checkpoint.rstrip('/')}-newest"

    def newest_before(batch_id: int) -> datetime | None:
        if batch_id == 0:
            return None
        return spark.read.parquet(f"{newest_dir}/batch={batch_id - 1}").first().newest

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = newest_before(batch_id)
        own = F.col(ts).cast("timestamp")
        late = F.lit(False) if before is None else F.coalesce(own < F.lit(before - within).cast("timestamp"), F.lit(False))
        folder = f"{out_dir}/batch={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(folder)
        written = spark.read.schema(batch.schema).parquet(folder).agg(F.max(own).alias("newest"))
        (written.select(F.greatest("newest", F.lit(before).cast("timestamp")).alias("newest"))
         .write.mode("overwrite").parquet(f"{newest_dir}/batch={batch_id}"))

    dedupe_requests(requests, within, key).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def run_once(stream: DataFrame, out_dir: str, checkpoint: str) -> None:
    """Process all there is into Parquet, then stop."""
    stream.writeStream.format("parquet").option("path", out_dir).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
