"""External command-line converters over tables of files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foliospark import values
from foliospark.functions.formats import hhmmss, mime_extension, ocr_language

# Bytes of output after which finished documents leave their task.
FLUSH = 4 << 20
RESULT = "content binary, status string, exit_code int, log string, seconds double"


def run_tool(docs: DataFrame, command: list[str] | Column, in_ext: str | Column = ".bin",
             out_name: str | Column = "output", timeout: float | None = None, parallel: int | None = None,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """Run a command once per document.

    ``{input}``, ``{output}`` and ``{dir}`` in the command stand for the input
    file, the expected output file and the fresh folder of that document. The
    command is started without a shell. A non-zero exit, a missing or empty
    output and a timeout (none unless given, in seconds) are rows with status error or timeout and the tool's
    log. ``out_name`` may be a pattern such as ``*.txt``: then ``<stem of the
    input>`` is preferred, else the first match by name is taken. Columns
    named in ``keep`` come through unchanged. ``parallel`` spreads the documents
    over so many tasks at least, and over several for each core, so that no core waits for a last round of tasks.
    """
    kept = ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import fnmatch
        import os
        import shutil
        import signal
        import subprocess
        import tempfile
        import time

        def pick(folder: str, wanted: str, given: str) -> str | None:
            if "*" not in wanted:
                path = os.path.join(folder, wanted)
                return path if os.path.exists(path) else None
            names = sorted(n for n in os.listdir(folder) if n != given and fnmatch.fnmatch(n, wanted))
            preferred = wanted.replace("*", os.path.splitext(given)[0])
            name = preferred if preferred in names else names[0] if names else None
            return None if name is None else os.path.join(folder, name)

        def one(folder, content, args, extension, wanted):
            started = time.monotonic()
            given = "input" + extension
            source, target = os.path.join(folder, given), os.path.join(folder, wanted)
            try:
                with open(source, "wb") as out:
                    out.write(bytes(content))
                filled = [a.replace("{input}", source).replace("{output}", target).replace("{dir}", folder)
                          for a in args]
                process = subprocess.Popen(
                    filled, stdin=subprocess.DEVNULL, stdout=subprocess.PIPE, stderr=subprocess.STDOUT,
                    cwd=folder, start_new_session=True)
                try:
                    log = process.communicate(timeout=timeout)[0].decode("utf-8", "replace")
                except subprocess.TimeoutExpired:
                    os.killpg(process.pid, signal.SIGKILL)
                    log = process.communicate()[0].decode("utf-8", "replace")
                    return None, "timeout", None, log, time.monotonic() - started
                if process.returncode != 0:
                    return None, "error", process.returncode, log, time.monotonic() - started
                path = pick(folder, wanted, given)
                if path is None or os.path.getsize(path) == 0:
                    return None, "error", 0, log + "\nno output", time.monotonic() - started
                with open(path, "rb") as result:
                    return result.read(), "ok", 0, log, time.monotonic() - started
            except (OSError, TypeError) as problem:
                return None, "error", None, str(problem), time.monotonic() - started

        def in_folder(folder, *job):
            os.mkdir(folder, 0o700)
            try:
                return one(folder, *job)
            finally:
                try:                                      # the usual case, a few files, without the costs of rmtree
                    for name in os.listdir(folder):
                        os.unlink(os.path.join(folder, name))
                    os.rmdir(folder)
                except OSError:
                    shutil.rmtree(folder, ignore_errors=True)

        def rows(own, done):
            columns = zip(*done, strict=True)
            made = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*own.columns, *made], [*kept, *names])

        kinds = [pa.binary(), pa.string(), pa.int32(), pa.string(), pa.float64()]
        names = [part.split()[0] for part in RESULT.split(", ")]
        with tempfile.TemporaryDirectory(prefix="tool-", ignore_cleanup_errors=True) as parent:
            number = 0
            for batch in batches:
                own, jobs = batch.select(range(len(kept))), batch.columns[len(kept):]
                start, done, size = 0, [], 0
                for i in range(batch.num_rows):
                    done.append(in_folder(os.path.join(parent, str(number)), *(column[i].as_py() for column in jobs)))
                    size, number = size + len(done[-1][0] or b"") + len(done[-1][3]), number + 1
                    if size >= FLUSH or i + 1 == batch.num_rows:     # so a batch of whole files is never held twice
                        yield rows(own.slice(start, i + 1 - start), done)
                        start, done, size = i + 1, [], 0

    def column(value) -> Column:
        if isinstance(value, Column):
            return value
        return F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)

    slim = docs.select(*kept, "content", column(command).alias("command"),
                       column(in_ext).alias("in_ext"), column(out_name).alias("out_name"))
    spread = slim if parallel is None else slim.repartition(
        max(parallel, 4 * docs.sparkSession.sparkContext.defaultParallelism))
    carried = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in kept)
    return spread.mapInArrow(run, f"{carried}, {RESULT}")


def pick_output(files: DataFrame) -> DataFrame:
    """Of the files a tool produced (doc_id, input_name, file_name), the transcript to keep.

    ``<stem of the input>.txt`` if present, else the first other .txt by name;
    documents without one have status error.
    """
    stem = F.regexp_replace("input_name", r"^(.+)\.[^.]*$", "$1")
    is_text = F.endswith("file_name", F.lit(".txt"))
    order = F.when(is_text, F.struct((F.col("file_name") != F.concat(stem, F.lit(".txt"))).alias("other"),
                                     F.col("file_name").alias("name")))
    best = files.groupBy("doc_id").agg(F.min(order).alias("best"))
    found = F.col("best").isNotNull()
    return best.select("doc_id", F.col("best.name").alias("file_name"),
                       F.when(found, "ok").otherwise("error").alias("status"))


def _command(*parts) -> Column:
    """Command array; parts that are null are left out."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.filter(F.array(*columns), lambda x: x.isNotNull())


def build_command(tool: str, pdf_engine: str = "xelatex", lua_filter: str | None = None,
                  reference_doc: str | None = None, script: str | None = None) -> Column:
    """Command array for a tool from typed option columns (see ``resolve_options``).

    Input, output and folder are left as ``{input}``, ``{output}``, ``{dir}``.
    ``lua_filter`` and ``reference_doc`` are paths that exist on every executor.
    """
    to_pdf = F.col("target_mime") == values.PDF if tool == "md2doc" else F.lit(True)

    def when(condition: Column, value: str | Column | None) -> Column:
        text = F.lit(None).cast("string") if value is None else F.lit(value) if isinstance(value, str) else value
        return F.when(condition, text)

    if tool in ("md2doc", "markdown"):
        toc = F.col("tocEnabled") if tool == "md2doc" else F.lit(False)
        depth = F.col("tocDepth").cast("string") if tool == "md2doc" else F.lit("")
        lua = None if lua_filter is None else f"--lua-filter={lua_filter}"
        doc = None if reference_doc is None else f"--reference-doc={reference_doc}"
        to_docx = F.col("target_mime") == values.DOCX if tool == "md2doc" else F.lit(False)
        return _command(
            "pandoc", "{input}", "-o", "{output}", "--standalone",
            when(toc, "--toc"), when(toc, F.concat(F.lit("--toc-depth="), depth)),
            when(to_pdf, f"--pdf-engine={pdf_engine}"), when(to_pdf, "-V"),
            when(to_pdf, "geometry:margin=2.5cm"), when(to_pdf, lua), when(to_docx, doc))
    if tool == "msg":
        return _command("pandoc", "{input}", "-o", "{output}", f"--pdf-engine={pdf_engine}")
    if tool == "html2md":
        return _command("pandoc", "-f", "html", "-t", "gfm", "{input}", "-o", "{output}")
    if tool == "md2html":
        return _command("pandoc", "-f", "markdown", "-t", "html5", "--standalone", "{input}", "-o", "{output}")
    if tool == "ocr":
        return _command("ocrmypdf", "--skip-text", "-l", ocr_language(F.col("language")), "{input}", "{output}")
    if tool == "whisper":
        return _command("whisper", "{input}", "--model", F.col("model"),
                        "--output_format", "txt", "--output_dir", "{dir}")
    if tool == "videothumb":
        return _command("ffmpeg", "-ss", hhmmss(F.col("timeOffset").cast("string")), "-i", "{input}",
                        "-vframes", "1", "-f", "image2", "{output}")
    if tool == "heic":
        return _command("heif-convert", "{input}", "{output}")
    if tool in ("pdf2docx", "convert2md", "pii"):
        if script is None:
            raise ValueError(f"{tool} runs a Python script: give its path")
        extra = [] if tool != "pii" else [
            "--entities", F.col("entities"), "--threshold", F.col("scoreThreshold").cast("string"),
            "--label", F.col("label")]
        return _command("python3", script, "--input", "{input}", "--output", "{output}", *extra)
    raise ValueError(f"unknown tool: {tool}")


# File name of the input (family or extension) and of the output, per tool.
_NAMES = {
    "md2doc": (".md", None), "markdown": (".md", "output.pdf"), "msg": (".md", "output.pdf"),
    "html2md": (".html", "output.md"), "md2html": (".md", "output.html"), "ocr": (".pdf", "ocr-output.pdf"),
    "whisper": ("whisper", "*.txt"), "videothumb": ("video", "output.jpg"), "heic": (".heic", None),
    "pdf2docx": (".pdf", "output.docx"), "convert2md": (".pdf", "output.md"), "pii": (".pdf", "pii-redacted.pdf"),
}


def convert(docs: DataFrame, tool: str, timeout: float | None = None, parallel: int | None = None,
            keep: tuple[str, ...] = (), **paths) -> DataFrame:
    """``run_tool`` with the command and file names of a known tool."""
    before, after = _NAMES[tool]
    in_ext = F.lit(before) if before.startswith(".") else mime_extension(F.col("source_mime"), before)
    if after is None:
        family = "image" if tool == "heic" else "result"
        dot = "" if tool == "heic" else "."
        out_name = F.concat(F.lit("output" + dot), mime_extension(F.col("target_mime"), family))
    else:
        out_name = F.lit(after)
    return run_tool(docs, build_command(tool, **paths), in_ext, out_name, timeout, parallel, keep)
