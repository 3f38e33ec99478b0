"""Folders of files in, results out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliospark import values
from foliospark.functions.formats import extension_mime, mime_extension
from foliospark.functions.text import decode_utf8

FILES_PER_BATCH = 10_000
# Bytes of contents after which files that were read leave their task.
FLUSH = 4 << 20
# Folders that one task lists before the others are dealt to all tasks.
FOLDERS = 32
# File systems whose files are those that Python opens.
LOCAL = ("org.apache.hadoop.fs.LocalFileSystem", "org.apache.hadoop.hive.ql.io.ProxyLocalFileSystem")
DOCUMENT = "doc_id string, source_mime string, content binary, size bigint"


def _as_documents(files: DataFrame, source_mime: str | None) -> DataFrame:
    mime = extension_mime(F.col("path")) if source_mime is None else F.lit(source_mime)
    return files.select(F.col("path").alias("doc_id"), mime.alias("source_mime"), "content",
                        F.col("length").alias("size"))


def read_documents(spark: SparkSession, path: str, source_mime: str | None = None,
                   max_bytes: int | None = None) -> DataFrame:
    """Files below ``path``; the media type comes from the extension unless given.

    Names that Spark counts as hidden and empty files are left out. Files larger than ``max_bytes`` are never opened, nor
    is any where ``content`` is not asked for. A local or mounted folder is listed and read by tasks, anew in each action,
    so the driver holds nothing for a file; as many tasks read as the session has shuffle partitions, at least four for
    each core. What only Spark's file systems open, patterns, single files and sessions that skip missing or corrupt files
    go through Spark's own reader, whose driver keeps every file's status.
    """
    folder = _local_folder(spark, path)
    if folder is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    else:
        files = _listed(spark, folder)
    if max_bytes is not None:
        files = files.filter(F.col("length") <= max_bytes)
    if folder is not None:
        # Dealt by name, so that a folder of any number of files is read by all tasks.
        files = files.repartition(_tasks(spark), "path").select(
            F.concat(F.lit("file:"), "path").alias("path"), "length", _contents(spark)("path").alias("content"))
    return _as_documents(files, source_mime)


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that ``path`` names, if it is one of the local file system and Python would read it as Spark does."""
    skips = [spark.conf.get(f"spark.sql.files.ignore{kind}Files").lower() == "true" for kind in ("Missing", "Corrupt")]
    jvm = getattr(spark, "_jvm", None)
    if jvm is None or any(skips) or set(path) & set("{}[]*?\\"):
        return None
    wanted = jvm.org.apache.hadoop.fs.Path(path)
    system = wanted.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    wanted = system.makeQualified(wanted)
    if system.getClass().getName() not in LOCAL or wanted.toUri().getScheme() != "file":
        return None
    return wanted.toUri().getPath() if system.exists(wanted) and system.getFileStatus(wanted).isDirectory() else None


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``length`` of the files below a local folder, as Spark lists them.

    The first task lists folders until it knows some; those it has not listed are dealt to all tasks, which go down into
    them. Entries leave as they are met: no task holds the names of a folder.
    """
    def entries(parent: str) -> Iterator[tuple[str, int | None]]:
        import errno
        import os

        with os.scandir(parent) as found:
            for entry in found:
                name = entry.name
                hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
                try:
                    name.encode()
                    if entry.is_dir():
                        if not hidden or name.startswith(("_metadata", "_common_metadata")):
                            yield entry.path, None
                    elif not hidden and (length := entry.stat().st_size):
                        yield entry.path, length
                except UnicodeEncodeError:                           # a name that is no text
                    pass
                except OSError as problem:
                    if problem.errno not in (errno.ENOENT, errno.ELOOP):     # a link to nothing or in a circle
                        raise

    def widen(parent: str) -> Iterator[tuple[str, int | None]]:
        pending, known = [parent], 1
        while pending and known < FOLDERS:
            for path, length in entries(pending.pop(0)):
                if length is None and known < FOLDERS:
                    pending.append(path)
                    known += 1
                else:
                    yield path, length
        yield from ((path, None) for path in pending)

    def descend(parent: str) -> Iterator[tuple[str, int | None]]:
        open_folders = [entries(parent)]
        while open_folders:
            path, length = next(open_folders[-1], (None, None))
            if path is None:
                open_folders.pop()
            elif length is None:
                open_folders.append(entries(path))
            else:
                yield path, length

    def step(walk: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from itertools import chain, islice

            def rows(*columns):
                return pa.RecordBatch.from_arrays([*columns], ["path", "length"])

            for batch in batches:
                path, length = batch.columns
                yield rows(*batch.filter(length.is_valid()).columns)
                met = chain.from_iterable(map(walk, path.filter(length.is_null()).to_pylist()))
                while found := list(islice(met, 10_000)):
                    paths, lengths = zip(*found, strict=True)
                    yield rows(pa.array(paths, path.type), pa.array(lengths, pa.int64()))
        return run

    kind = "path string, length bigint"
    root = spark.range(0, 1, 1, 1).select(F.lit(folder).alias("path"), F.lit(None).cast("bigint").alias("length"))
    return root.mapInArrow(step(widen), kind).repartition(_tasks(spark), "path").mapInArrow(step(descend), kind)


def _contents(spark: SparkSession) -> Callable:
    """Local paths to contents; a column, so that it is left out of plans that do not need it."""
    limit = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))

    def read(paths: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import os
        import zlib

        def check(path: str, content: bytes) -> None:
            """Hold a file against the sums that Hadoop has written beside it, if it has."""
            folder, name = os.path.split(path)
            try:
                with open(os.path.join(folder, f".{name}.crc"), "rb") as file:
                    sums = file.read()
            except OSError:
                return
            if len(sums) < 8 or sums[:4] != b"crc\0":
                return
            view, step = memoryview(content), int.from_bytes(sums[4:8], "big")
            found = b"".join(zlib.crc32(view[i:i + step]).to_bytes(4, "big") for i in range(0, len(content), step))
            if not sums[8:].startswith(found):
                raise OSError(f"Checksum error: {path}")

        for batch in paths:
            done, size = [], 0
            for path in batch:
                with open(path, "rb") as file:
                    if (length := os.fstat(file.fileno()).st_size) > limit:
                        raise ValueError(f"{path}: {length} bytes are more than the {limit} that may be read")
                    if done and size + length > FLUSH:
                        yield pd.Series(done, dtype=object)
                        done, size = [], 0
                    done.append(file.read())
                check(path, done[-1])
                size += len(done[-1])
            if done:
                yield pd.Series(done, dtype=object)

    return F.pandas_udf(read, "binary")


def stream_documents(spark: SparkSession, path: str, source_mime: str | None = None,
                     files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New files below ``path`` as a streaming table of documents."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = (spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", files_per_batch).load(path))
    return _as_documents(files, source_mime)


def decode_text(docs: DataFrame) -> DataFrame:
    """Bytes to text; PDF has no text without a tool and becomes status unsupported."""
    pdf = F.col("source_mime") == values.PDF
    return docs.select(
        "doc_id", "source_mime",
        F.when(~pdf, decode_utf8(F.col("content"))).alias("text"),
        F.when(pdf, "unsupported").otherwise("ok").alias("status"),
        F.when(pdf, F.lit("text of PDF needs an external tool")).alias("error"))


def with_file_name(results: DataFrame) -> DataFrame:
    """Add ``file_name``: the document id and the extension of the target type.

    An id that is a path keeps its folders, so that equal names in different
    folders stay apart; scheme, root and ``..`` are taken out.
    """
    path = F.regexp_replace(F.col("doc_id").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*:(?=/)", "")
    stem = F.regexp_replace(F.regexp_replace(path, r"^/+", ""), r"(^|/)\.\.(?=/|$)", "$1_")
    return results.withColumn("file_name", F.concat_ws(".", stem, mime_extension(F.col("target_mime"), "result")))


def write_results(results: DataFrame, path: str, mode: str = "append") -> None:
    """Results as Parquet, one folder per target type, each row with its file name.

    Rows are gathered by target before writing only within tasks (no shuffle),
    so a target that holds most rows is still written by all tasks.
    """
    named = with_file_name(results).withColumn("target", mime_extension(F.col("target_mime"), "result"))
    named.write.mode(mode).partitionBy("target").parquet(path)


def export_files(results: DataFrame, folder: str) -> DataFrame:
    """Write each result to its own file below ``folder``: a path or URI that all executors share.

    Returns one row per document with the file written; evaluated by an action.
    A file appears under its name only when complete, so a repeated task does no harm.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import posixpath
        import re
        import uuid

        from pyarrow import fs

        if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", folder):
            system, root = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))
        else:
            system, root = fs.LocalFileSystem(), folder
        made = set()

        def store(path: str, content: bytes) -> None:
            parent = posixpath.dirname(path)
            if parent not in made:
                system.create_dir(parent, recursive=True)
                made.add(parent)
            partial = f"{path}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(partial) as out:
                out.write(content)
            system.move(partial, path)

        for batch in batches:
            rows = []
            for doc_id, target, name, content in zip(
                    batch["doc_id"], batch["target"], batch["file_name"], batch["content"]):
                path = posixpath.join(root, target, name)
                try:
                    store(path, content)
                    rows.append((doc_id, path, "ok", None))
                except OSError as problem:
                    rows.append((doc_id, path, "error", str(problem)))
            yield pd.DataFrame(rows, columns=["doc_id", "path", "status", "error"])

    named = with_file_name(results).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        mime_extension(F.col("target_mime"), "result").alias("target"), "file_name",
        F.coalesce("content", F.lit(b"")).alias("content"))
    return named.mapInPandas(write, "doc_id string, path string, status string, error string")
